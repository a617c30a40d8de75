"""The functions under their SQL names, as SQL-bodied temporary functions.

Bodies are ordinary expressions that the optimizer inlines; no Python runs per row.
The two sketches take the group's collected hash set:
``MINHASH_SIGNATURE(collect_set(FEATURE_HASH(sch_tpl, ts_tpl, event_type)))`` and
``BF_AGG(collect_set(LOCATION_HASH(ts_tpl)))``. The DataFrame operators give the
same values with bounded groups and are the choice for very large ones.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from feedlake.functions.hashing import MERSENNE_31, coefficients
from feedlake.operators.sketches import (
    FILTER_BITS,
    FILTER_HASHES,
    FILTER_SEED,
    SIGNATURE_LENGTH,
    SIGNATURE_SEED,
)


def _longs(values) -> str:
    return "array(" + ", ".join(f"{v}L" for v in values) + ")"


def _definitions(sensitivity: float, epsilon: float) -> dict[str, str]:
    fold = (
        "CASE WHEN c < 65536 THEN (h * 31 + c) & 4294967295L ELSE"
        " ((h * 31 + (shiftright(c - 65536, 10) + 55296)) * 31 + ((c - 65536) & 1023) + 56320) & 4294967295L END"
    )
    sig, bloom = coefficients(SIGNATURE_LENGTH, SIGNATURE_SEED), coefficients(FILTER_HASHES, FILTER_SEED)
    pairs = f"arrays_zip({_longs(a for a, _ in bloom)}, {_longs(b for _, b in bloom)})"
    positions = f"transform({pairs}, p -> pmod(p['0'] * h + p['1'], {FILTER_BITS}L))"
    byte = (
        f"lpad(hex(aggregate(filter(array_distinct(flatten(transform(hs, h -> {positions}))), b -> b div 8 = i),"
        " 0, (acc, b) -> acc + shiftleft(1, CAST(b % 8 AS INT)))), 2, '0')"
    )
    return {
        "JAVA_HASH(s STRING) RETURNS BIGINT": (
            "aggregate(transform(split(coalesce(s, ''), ''), x -> CAST(ascii(x) AS BIGINT)), 0L,"
            f" (h, c) -> {fold}, h -> CASE WHEN h >= 2147483648L THEN h - 4294967296L ELSE h END)"
        ),
        "FEATURE_HASH(a STRING, b STRING, c STRING) RETURNS BIGINT": (
            "JAVA_HASH(concat_ws('|', coalesce(a, 'NULL'), coalesce(b, 'NULL'), coalesce(c, 'NULL')))"
        ),
        "LOCATION_HASH(s STRING) RETURNS BIGINT": "CASE WHEN s IS NOT NULL THEN JAVA_HASH(s) END",
        "MINHASH_SIGNATURE(hs ARRAY<BIGINT>) RETURNS ARRAY<BIGINT>": (
            f"CASE WHEN size(hs) > 0 THEN zip_with({_longs(a for a, _ in sig)}, {_longs(b for _, b in sig)},"
            f" (a, b) -> array_min(transform(hs, h -> pmod(a * h + b, {MERSENNE_31}L))))"
            " ELSE CAST(array() AS ARRAY<BIGINT>) END"
        ),
        "BF_AGG(hs ARRAY<BIGINT>) RETURNS STRING": (
            "regexp_replace(base64(unhex(regexp_replace(array_join(transform(sequence(0L,"
            f" {FILTER_BITS // 8 - 1}L), i -> {byte}), ''), '^((?:..)*?)(?:00)+$', '$1'))), '[\\\\r\\\\n]', '')"
        ),
        "CalculateSimilarity(a ARRAY<BIGINT>, b ARRAY<BIGINT>) RETURNS DOUBLE": (
            "CASE WHEN size(a) > 0 AND size(a) = size(b) THEN"
            " size(filter(zip_with(a, b, (x, y) -> coalesce(x = y, false)), z -> z)) / size(a) ELSE 0.0D END"
        ),
        "AddLaplaceNoise(v BIGINT) RETURNS DOUBLE": (
            f"v - {sensitivity / epsilon!r}D * aggregate(array((rand() - 0.5D) * {1 - 2.0**-52!r}D), 0.0D,"
            " (acc, u) -> signum(u) * ln(1 - 2 * abs(u)))"
        ),
    }


def register_sql_functions(spark: SparkSession, sensitivity: float = 1.0, epsilon: float = 1.0) -> list[str]:
    """Create the temporary functions in a session; returns their names."""
    if sensitivity <= 0 or epsilon <= 0:
        raise ValueError("sensitivity and epsilon must be positive")
    names = []
    for head, body in _definitions(sensitivity, epsilon).items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
        names.append(head.split("(")[0])
    return names
