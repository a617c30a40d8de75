"""Mergeable per-group summaries: MinHash signatures and Bloom filters."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions import bits
from feedlake.functions.expressions import feature_string
from feedlake.functions.hashing import MERSENNE_31, coefficients, java_hash, universal_hash
from feedlake.operators.skew import HEAVY_ROWS

# Signature length and seed, filter geometry and seed.
SIGNATURE_LENGTH, SIGNATURE_SEED = 128, 42
FILTER_BITS, FILTER_HASHES, FILTER_SEED = 512, 7, 123

FEATURE_COLUMNS = ("sch_tpl", "ts_tpl", "event_type")

def _minima(hashed: DataFrame, keys: Sequence[str | Column], length: int, seed: int) -> DataFrame:
    """The least universal hash of ``_h`` per group and position: constant state, combined on the map side."""
    names = [f"m{i}" for i in range(length)]
    pairs = zip(names, coefficients(length, seed))
    minima = [F.min(universal_hash(F.col("_h"), a, b, MERSENNE_31)).alias(n) for n, (a, b) in pairs]
    grouped = hashed.groupBy(*keys).agg(*minima)
    kept = [c for c in grouped.columns if c not in names]
    return grouped.select(*kept, F.array(*names).alias("minhash_signature"))


def _least(hashes: str, length: int, seed: int) -> Column:
    """The least universal hash of a list per position."""
    pairs = F.lit(json.dumps([{"a": a, "b": b} for a, b in coefficients(length, seed)]))
    pairs = F.from_json(pairs, "array<struct<a bigint, b bigint>>")
    modulus = F.lit(MERSENNE_31).cast("bigint")
    return F.transform(pairs, lambda c: F.array_min(F.transform(hashes, lambda h: F.pmod(c["a"] * h + c["b"], modulus))))


def minhash_signature(
    df: DataFrame,
    keys: Sequence[str],
    features: Sequence[str] = FEATURE_COLUMNS,
    length: int = SIGNATURE_LENGTH,
    seed: int = SIGNATURE_SEED,
) -> DataFrame:
    """One signature per group of ``keys`` over the distinct features of its rows.

    Repeated features go first, in a shuffle of 8-byte hashes that spreads a hot group
    by its features. What is left moves as hashes too, which are narrower than the
    ``length`` minima, and a group's minima are taken from the list of its hashes, so no
    table of minima is held or spilled; only groups of more than ``HEAVY_ROWS`` features
    move as minima, one row per task, and no list is longer than that.
    """
    hashed = df.select(*keys, java_hash(feature_string(*[F.col(f) for f in features])).alias("_h")).distinct()
    heavy = F.broadcast(hashed.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > HEAVY_ROWS).drop("_n"))
    # so many tasks even where the hashes are few bytes, as the minima of each cost far more than reading it
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    light = hashed.join(heavy, list(keys), "left_anti").repartition(parts, *keys).groupBy(*keys).agg(F.collect_list("_h").alias("_hs"))
    rest = hashed.join(heavy, list(keys), "left_semi")
    return light.select(*keys, _least("_hs", length, seed).alias("minhash_signature")).unionByName(_minima(rest, keys, length, seed))


def minhash_running(
    df: DataFrame,
    keys: Sequence[str | Column],
    features: Sequence[str] = FEATURE_COLUMNS,
    length: int = SIGNATURE_LENGTH,
    seed: int = SIGNATURE_SEED,
) -> DataFrame:
    """The same signature in one stateful step, for streams: repeated features aren't removed first."""
    return _minima(df.withColumn("_h", java_hash(feature_string(*[F.col(f) for f in features]))), keys, length, seed)


def minhash_merge(
    df: DataFrame, keys: Sequence[str], signature: str = "minhash_signature", length: int = SIGNATURE_LENGTH
) -> DataFrame:
    """Signature of the union of the groups' feature sets: the position-wise minimum."""
    minima = [F.min(F.get(F.col(signature), F.lit(i))).alias(f"m{i}") for i in range(length)]
    merged = F.filter(F.array(*[F.col(f"m{i}") for i in range(length)]), lambda v: v.isNotNull())
    return df.groupBy(*keys).agg(*minima).select(*keys, merged.alias(signature))


def bloom_words(
    df: DataFrame,
    keys: Sequence[str | Column],
    element: str,
    n_bits: int = FILTER_BITS,
    hashes: int = FILTER_HASHES,
    seed: int = FILTER_SEED,
) -> DataFrame:
    """Per group, the filter of its non-NULL elements as BIGINT words ``w0..``."""
    known = F.col(element).isNotNull()
    words = F.when(known, bits.words_with(java_hash(F.col(element)), n_bits, hashes, seed))
    marked = df.withColumn("_w", words)
    merged = [F.bit_or(F.get(F.col("_w"), F.lit(j))).alias(f"w{j}") for j in range(n_bits // 64)]
    return marked.groupBy(*keys).agg(*merged)


def bloom_filter(
    df: DataFrame,
    keys: Sequence[str | Column],
    element: str = "ts_tpl",
    n_bits: int = FILTER_BITS,
    hashes: int = FILTER_HASHES,
    seed: int = FILTER_SEED,
) -> DataFrame:
    """Per group, the filter as Base64 text; a group of NULLs gives the empty string."""
    return words_as_text(bloom_words(df, keys, element, n_bits, hashes, seed), n_bits)


def words_as_text(df: DataFrame, n_bits: int = FILTER_BITS) -> DataFrame:
    names = [f"w{j}" for j in range(n_bits // 64)]
    kept = [c for c in df.columns if c not in names]
    text = bits.words_to_text([F.col(n) for n in names])
    return df.select(*kept, text.alias("bloom_filter_base64"))


def bloom_merge(
    df: DataFrame, keys: Sequence[str], text: str = "bloom_filter_base64", n_bits: int = FILTER_BITS
) -> DataFrame:
    """Union of encoded filters per group, encoded again."""
    words = bits.text_to_words(F.col(text), n_bits)
    merged = df.select(*keys, *[w.alias(f"w{j}") for j, w in enumerate(words)]).groupBy(*keys)
    return words_as_text(
        merged.agg(*[F.bit_or(f"w{j}").alias(f"w{j}") for j in range(n_bits // 64)]), n_bits
    )


def might_contain(
    text: Column,
    element: Column,
    n_bits: int = FILTER_BITS,
    hashes: int = FILTER_HASHES,
    seed: int = FILTER_SEED,
) -> Column:
    """Whether all bits of ``element`` are set in an encoded filter.

    May be true for an element that was never added, never false for one that was.
    """
    pairs = F.array(
        *[F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"))
          for a, b in coefficients(hashes, seed)]
    )
    size = F.lit(n_bits).cast("bigint")
    # one-element array: binds the decoded filter and the hash once for all k tests
    probe = F.array(F.struct(F.hex(F.unbase64(text)).alias("digits"), java_hash(element).alias("h")))
    return F.exists(
        probe,
        lambda x: F.forall(pairs, lambda p: bits.digit_has(x["digits"], F.pmod(p["a"] * x["h"] + p["b"], size))),
    )
