"""Table functions of SQL that fold a group into constant state."""

import random

import pytest
from pyspark.sql import functions as F

from feedlake.functions import sqltables
from feedlake.functions.sqlnames import register_sql_functions
from feedlake.operators import sketches

SCHEMA = "rid string, n bigint, sch_tpl string, ts_tpl string, event_type string"


@pytest.fixture(scope="module")
def sql(spark):
    register_sql_functions(spark)
    assert sqltables.register_sql_tables(spark) == ["MINHASH_SIGNATURES", "BLOOM_FILTERS"]
    return spark.sql


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def _joined(spark):
    rng = random.Random(5)
    names = [None, "", "PADTLL", "CLPHMJC", "\U0001f682", *map(str, range(40))]
    keys = [(None, None), ("q", None), ("q", 2**60 + 1), ("q", 2**60 + 2), ("only nulls", 0)]
    rows = [(*keys[rng.randrange(4)], rng.choice(names), rng.choice(names), rng.choice(["arr", None])) for _ in range(5000)]
    return spark.createDataFrame(rows + [(*keys[4], None, None, None)], SCHEMA)


def test_same_as_the_operators(spark, sql):
    df = _joined(spark)
    signatures = sql("SELECT * FROM MINHASH_SIGNATURES(TABLE(SELECT rid, n, FEATURE_HASH(sch_tpl, ts_tpl, event_type) FROM {df}))", df=df)
    assert signatures.columns == ["rid", "n", "minhash_signature"]
    assert _rows(signatures) == _rows(sketches.minhash_signature(df, ["rid", "n"]))
    filters = sql("SELECT * FROM BLOOM_FILTERS(TABLE(SELECT rid, n, LOCATION_HASH(ts_tpl) FROM {df}))", df=df)
    assert _rows(filters) == _rows(sketches.bloom_filter(df, ["rid", "n"]))


@pytest.mark.parametrize("name, value, column", [
    ("MINHASH_SIGNATURES", "FEATURE_HASH(sch_tpl, ts_tpl, event_type)", "minhash_signature"),
    ("BLOOM_FILTERS", "LOCATION_HASH(ts_tpl)", "bloom_filter_base64"),
])
def test_parts_fold_to_the_whole(spark, sql, name, value, column):
    df = _joined(spark).withColumn("part", F.pmod(F.xxhash64("sch_tpl", "ts_tpl"), F.lit(7)))
    whole = sql(f"SELECT * FROM {name}(TABLE(SELECT rid, n, {value} FROM {{df}}))", df=df)
    inner = f"SELECT rid, n, {column} FROM {name}(TABLE(SELECT rid, n, part, {value} FROM {{df}}))"
    assert _rows(sql(f"SELECT * FROM {name}(TABLE({inner}))", df=df)) == _rows(whole)


def test_edges(spark, sql):
    def only(name, query):
        return [tuple(r) for r in sql(f"SELECT * FROM {name}(TABLE({query}))").collect()]

    assert only("MINHASH_SIGNATURES", "SELECT id FROM range(0)") == []
    assert only("MINHASH_SIGNATURES", "SELECT 1 AS `a ``b`, CAST(NULL AS BIGINT) AS h") == [(1, [])]
    assert only("BLOOM_FILTERS", "SELECT NULL AS k, NULL AS h") == [(None, "")]
    assert only("BLOOM_FILTERS", "SELECT 'x' AS k, '' AS done") == [("x", "")]
    (everything,) = only("MINHASH_SIGNATURES", "SELECT id FROM range(0, 5000, 1, 6)")
    (halves,) = only("MINHASH_SIGNATURES", "SELECT minhash_signature FROM MINHASH_SIGNATURES(TABLE(SELECT id % 2 AS k, id FROM range(5000)))")
    assert everything == halves and len(everything[0]) == sketches.SIGNATURE_LENGTH
    for name in ("MINHASH_SIGNATURES", "BLOOM_FILTERS"):
        with pytest.raises(Exception, match="last column"):
            only(name, "SELECT 1 AS k, 1.5D AS h")


def test_a_large_group_waits_for_nothing(spark, sql):
    """One group of many rows; whatever came before, at most a chunk of hashes is kept."""
    fold = sqltables.MinhashSignatures()
    for h in range(10 * sqltables.CHUNK + 5):
        fold.eval(("k", h))
        assert len(fold.waiting) < sqltables.CHUNK
    (row,) = sql("SELECT * FROM MINHASH_SIGNATURES(TABLE(SELECT 'k' AS k, id % 700 AS h FROM range(200000)))").collect()
    (few,) = sql("SELECT * FROM MINHASH_SIGNATURES(TABLE(SELECT 'k' AS k, id AS h FROM range(700)))").collect()
    assert row == few
