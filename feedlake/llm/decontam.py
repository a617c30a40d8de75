"""Benchmark decontamination by winnowing, in built-in expressions alone.

Of every ``WINDOW`` consecutive hashes of ``GRAM`` words the smallest is kept as a
fingerprint of the text, on both sides. A shared span of ``SPAN = GRAM + WINDOW - 1``
words holds the same such window in both texts and so the same fingerprint: joining
fingerprints misses none. Items of fewer words are found by the hash of the whole
item among all runs of that many words. Each pair of equal hashes then names a
diagonal, along which the words of text and item are compared; runs of at least
``SPAN`` equal words (or the whole of a shorter item) are the hits.

Texts are told apart by digest, so copies are joined and compared once. Null and
empty texts have no words and no hits; items without words match nothing; items
without an id hit words but aren't counted or listed. Ids may be null or repeated:
there is one row per input row. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.store import settle

GRAM, WINDOW = 5, 6
SPAN = GRAM + WINDOW - 1
#: Characters between words, once A-Z are lower-cased.
GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Letters that lower() would change although they aren't A-Z.
OTHER_CAPITALS = r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of at most some 100 bytes that may be broadcast; beyond that Spark shuffles and splits skewed keys.
BROADCAST_ROWS = 200_000


def small(df: DataFrame) -> DataFrame:
    """A settled table, marked for broadcast if it is counted to be small."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def word_hashes(text: Column) -> Column:
    """A 64-bit hash per word of a text that isn't null."""
    plain = F.when(text.rlike(OTHER_CAPITALS), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.transform(F.split(plain, GAPS), lambda w: F.when(w != "", F.xxhash64(w)))


def with_hashes(texts: DataFrame) -> DataFrame:
    """``key, hashes`` of ``text``: its digest and its words' hashes."""
    hashed = texts.select(F.unhex(F.md5("text")).alias("key"), word_hashes(F.col("text")).alias("hashes"))
    # Only the first and the last word can be empty.
    first = F.get("hashes", F.lit(0)).isNull().cast("int")
    last = (F.get("hashes", F.size("hashes") - 1).isNull() & (F.size("hashes") > 1)).cast("int")
    cut = F.slice("hashes", first + 1, F.size("hashes") - first - last)
    return hashed.select("key", cut.alias("hashes"))


def _runs(values: str, length: int, combine) -> Column:
    """``combine`` of each run of ``length`` consecutive values, in order."""
    last = F.size(values) - length
    every = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: combine(*(F.get(values, i + j) for j in range(length))),
    )
    return F.when(last >= 0, every).otherwise(F.array().cast("array<bigint>"))


def fingerprints(hashed: DataFrame, short: list[int]) -> DataFrame:
    """``key, hash``: the winnowed hashes of each text and those of its runs of each length in ``short``."""
    grams = hashed.withColumn("grams", _runs("hashes", GRAM, F.xxhash64))
    kept = grams.withColumn("kept", F.array_distinct(_runs("grams", WINDOW, F.least)))
    for n in short:
        kept = kept.withColumn("kept", F.concat("kept", F.array_distinct(_runs("hashes", n, F.xxhash64))))
    # The outer form, since a filter on the array's size would be moved down and compute the array again.
    return kept.select("key", F.explode_outer("kept").alias("hash")).where("hash IS NOT NULL")


def positions(hashed: DataFrame, short: list[int]) -> DataFrame:
    """``key, hash, at`` for every run of ``GRAM`` words or of a length in ``short``."""
    out = None
    for n in sorted({GRAM, *short}):
        own = hashed.select("key", F.posexplode_outer(_runs("hashes", n, F.xxhash64)).alias("at", "hash"))
        out = own if out is None else out.unionByName(own)
    return out


def equal_runs(pairs: DataFrame) -> DataFrame:
    """``key, item, start, end``: hit spans along the diagonals ``shift`` of ``hashes`` and ``item_hashes``."""
    low = F.greatest(F.lit(0), F.col("shift"))
    high = F.least(F.size("hashes"), F.col("shift") + F.size("item_hashes")) - 1
    unequal = lambda i: F.get("hashes", i) != F.get("item_hashes", i - F.col("shift"))
    breaks = F.filter(
        F.sequence(low - 1, high + 1), lambda i: (i < low) | (i > high) | F.coalesce(unequal(i), F.lit(False))
    )
    between = pairs.select("key", "item", F.size("item_hashes").alias("n"), breaks.alias("breaks"))
    spans = F.transform(
        F.sequence(F.lit(0), F.size("breaks") - 2),
        lambda j: F.struct((F.get("breaks", j) + 1).alias("start"), (F.get("breaks", j + 1) - 1).alias("end")),
    )
    long_enough = F.filter(spans, lambda s: s["end"] - s["start"] + 1 >= F.least(F.lit(SPAN), F.col("n")))
    return between.select("key", "item", F.inline_outer(long_enough)).where("start IS NOT NULL")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per document."""
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    hashed_items = with_hashes(items.select("text").distinct()).where(F.size("hashes") > 0)
    hashed_items = settle(hashed_items, "benchmark-items")
    short = hashed_items.select(F.size("hashes").alias("n")).where(F.col("n") < SPAN).distinct()
    short = sorted(r.n for r in short.collect())  # at most SPAN - 1 numbers

    # Which texts share a fingerprint with which items.
    wanted = fingerprints(hashed_items, []).unionByName(
        hashed_items.where(F.size("hashes") < SPAN).select("key", _whole_hash(short).alias("hash"))
    )
    wanted = settle(wanted.select("hash", F.col("key").alias("item")).distinct(), "benchmark-fingerprints")
    seeds = fingerprints(with_hashes(texts), short).join(small(wanted.select("hash").distinct()), "hash", "left_semi")
    seeds = settle(seeds.distinct(), "seeds")

    # The words of those texts, and the diagonals that the seeds lie on.
    keyed = texts.withColumn("key", F.unhex(F.md5("text")))
    found = keyed.join(small(seeds.select("key").distinct()), "key", "left_semi")
    hashed = settle(with_hashes(found.select("text")).dropDuplicates(["key"]), "seeded-texts")
    at_item = positions(hashed_items, short).join(wanted.withColumnRenamed("item", "key"), ["key", "hash"])
    at_item = at_item.select("hash", F.col("key").alias("item"), F.col("at").alias("item_at"))
    at_text = positions(hashed, short).join(small(seeds), ["key", "hash"])
    diagonals = at_text.join(at_item, "hash")
    diagonals = diagonals.select("key", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct()
    item_words = hashed_items.select(F.col("key").alias("item"), F.col("hashes").alias("item_hashes"))
    spans = settle(equal_runs(diagonals.join(item_words, "item").join(hashed, "key")).distinct(), "spans")

    # Words hit, as the length of the union of the spans, and the items found.
    by_start = Window.partitionBy("key").orderBy("start", "end")
    before = F.coalesce(F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    fresh = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start") - 1, before))
    words = spans.select("key", "start", "end").distinct().withColumn("fresh", fresh)
    words = words.groupBy("key").agg(F.sum("fresh").alias("n_hit"))
    ids = items.select(F.unhex(F.md5("text")).alias("item"), F.col("item_id").cast("string").alias("item_id"))
    named = spans.select("key", "item").distinct().join(ids.where("item_id IS NOT NULL").distinct(), "item")
    named = named.groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("ids"))
    named = named.select("key", F.size("ids").alias("n_items"), F.array_join("ids", ",").alias("ids"))
    hits = settle(words.join(named, "key", "left"), "hit-texts")
    counted = keyed.select("doc_id", "key", F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("n_words"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("bigint")
    return counted.join(small(hits), "key", "left").select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.col("n_items"), F.lit(0)).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.col("ids"), F.lit("")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def _whole_hash(short: list[int]) -> Column:
    """The hash of all words of an item, for the lengths in ``short``."""
    out = F.lit(None).cast("bigint")
    for n in short:
        out = F.when(F.size("hashes") == n, F.xxhash64(*(F.get("hashes", F.lit(j)) for j in range(n)))).otherwise(out)
    return out
