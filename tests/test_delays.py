from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.operators import counts, delays
from feedlake.operators.skew import heavy_keys, join_to_unique
from feedlake.plans import jobs
from feedlake.session import work_dir

START = datetime(2025, 4, 30, 12, 0, 0)
PLAN = "rid string, tpl string, event_time timestamp, wta string, wtd string, wtp string"
SEEN = "rid string, tpl string, event_time timestamp, event_type string, actual_time string"


def _at(minutes):
    return START + timedelta(minutes=minutes)


@pytest.mark.parametrize(
    "later,earlier,minutes",
    [
        ("12:05", "12:00", 5.0),
        ("12:00:30", "12:00", 0.5),
        ("00:10", "23:50", 20.0),
        ("23:50", "00:10", -20.0),
        ("12:00", "00:00", 720.0),
        ("x", "12:00", None),
        (None, "12:00", None),
    ],
)
def test_clock_difference(spark, later, earlier, minutes):
    df = spark.createDataFrame([(later, earlier)], "l string, e string")
    assert df.select(delays.clock_difference(F.col("l"), F.col("e"))).first()[0] == minutes


def test_delay_uses_latest_plan_and_event(spark):
    plan = spark.createDataFrame(
        [
            ("r", "A", _at(0), "10:00", "10:02", None),
            ("r", "A", _at(1), "10:01", "10:03", None),
            ("r", "B", _at(0), None, None, "10:10"),
        ],
        PLAN,
    )
    seen = spark.createDataFrame(
        [
            ("r", "A", _at(5), "arr", "10:05"),
            ("r", "A", _at(6), "dep", "10:05"),
            ("r", "B", _at(7), "arr", "10:12"),
            ("r", "C", _at(8), "arr", "10:12"),
            ("r", "A", _at(9), "arr", None),
        ],
        SEEN,
    )
    got = delays.delay_calc(plan, seen).orderBy("event_time").collect()
    assert [(r.tpl, r.delay) for r in got] == [("A", 4.0), ("A", 2.0), ("B", 2.0)]


def test_forecast_counts_where_there_is_no_actual_time(spark):
    plan = spark.createDataFrame([("r", "A", _at(0), "10:00", "10:02", None)], PLAN)
    seen = spark.createDataFrame(
        [("r", "A", _at(5), "arr", "10:05", "10:09"), ("r", "A", _at(6), "arr", None, "10:07"), ("r", "A", _at(7), "arr", None, None)],
        SEEN + ", forecast_time string",
    )
    got = delays.delay_calc(plan, seen).orderBy("event_time").collect()
    assert [r.delay for r in got] == [5.0, 7.0]


def test_join_to_unique_spreads_a_hot_key(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 400, 0).otherwise(F.col("id")).alias("k"), "id")
    unique = spark.range(0, 1000, 2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    heavy = heavy_keys(rows, ["k"], 50)
    assert [tuple(r) for r in heavy.collect()] == [(0, 400)]
    for how in ("inner", "left"):
        got = join_to_unique(rows, unique, ["k"], heavy, ["id"], how, limit=50)
        assert sorted(got.collect(), key=lambda r: r.id) == sorted(rows.join(unique, "k", how).collect(), key=lambda r: r.id)


def _many(spark, n=400):
    rng = np.random.default_rng(3)
    rows = [
        ("hot" if k % 3 == 0 else f"j{k % 11}", f"T{k % 5}", _at(float(rng.integers(0, 2000))), float(rng.integers(-5, 30)))
        for k in range(n)
    ]
    return rows, spark.createDataFrame(rows, "rid string, tpl string, event_time timestamp, delay double")


def _by_journey(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r[2], r[1], r[3])):
        out.setdefault(r[0], []).append(r)
    return out


def test_delay_vector(spark):
    rows, df = _many(spark)
    got = {r.rid: r.delays for r in delays.delay_vector(df).collect()}
    assert got == {rid: [r[3] for r in rs[-5:]] for rid, rs in _by_journey(rows).items()}


def test_delay_vector_limits_rows_before_the_shuffle(spark):
    _, df = _many(spark)
    plan = delays.delay_vector(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("chunk", ["10 minutes", "3 hours", "30 days"])
def test_running_vector_is_the_same_for_any_chunk(spark, chunk):
    rows, df = _many(spark)
    want = sorted(
        (rid, r[2], r[1], r[3], [x[3] for x in rs[max(0, i - 4) : i + 1]])
        for rid, rs in _by_journey(rows).items()
        for i, r in enumerate(rs)
    )
    got = delays.running_delay_vector(df, chunk=chunk).collect()
    assert sorted((r.rid, r.event_time, r.tpl, r.delay, r.delays) for r in got) == want


def test_buckets(spark):
    normals = delays.planes(6, 5)
    assert normals == delays.planes(6, 5) != delays.planes(6, 5, seed=1)
    vectors = [[1.0, 2.0, 3.0, 4.0, 5.0], [-1.0, -2.0, -3.0, -4.0, -5.0], [1.0], []]
    df = spark.createDataFrame([(v,) for v in vectors], "v array<double>")
    got = [r[0] for r in df.select(delays.lsh_bucket(F.col("v"), normals)).collect()]

    def expected(v):
        padded = v + [0.0] * (5 - len(v))
        return "".join("1" if sum(a * b for a, b in zip(padded, n)) >= 0 else "0" for n in normals)

    assert got == [expected(v) for v in vectors]
    assert df.select(delays.lsh_bucket(F.lit(None).cast("array<double>"), normals)).first()[0] is None


def test_buckets_do_not_depend_on_width(spark):
    wide = [n + [0.0] * 20 for n in delays.planes(6, 5)]
    rng = np.random.default_rng(1)
    rows = [([float(x) for x in rng.normal(size=5)],) for _ in range(50)] + [(None,), ([1.0, None, 0.5],), ([0.5] * 40,)]
    df = spark.createDataFrame(rows, "v array<double>")
    both = df.select(
        delays.lsh_bucket(F.col("v"), delays.planes(6, 5)).alias("a"), delays.lsh_bucket(F.col("v"), wide).alias("b")
    )
    assert both.filter("NOT a <=> b").count() == 0


@pytest.mark.parametrize(
    "vector,text",
    [
        ([0.0, 0.5], "Bucket b: no initial delay, steady"),
        ([3.0, 9.0], "Bucket b: low initial delay, worsening"),
        ([20.0, 2.0], "Bucket b: high initial delay, recovering"),
        ([], None),
    ],
)
def test_explanations(spark, vector, text):
    df = spark.createDataFrame([(vector,)], "v array<double>")
    assert df.select(delays.explain_bucket(F.lit("b"), F.col("v"))).first()[0] == text


def test_moments_of_union_equal_direct_moments(spark):
    rows, df = _many(spark)
    seen = df.select("rid", "tpl", "event_time", F.lit("arr").alias("event_type"),
                     F.date_format(F.timestamp_seconds(F.col("delay") * 60 + 43200), "HH:mm").alias("actual_time"))
    plan = df.select("rid", "tpl", "event_time", F.lit("12:00").alias("wta"), F.lit("12:00").alias("wtd"), F.lit("12:00").alias("wtp"))
    got = jobs.pattern_moments(plan, seen, work_dir(spark, "moments"))
    bucket = jobs.delay_patterns(plan, seen).select("rid", "bucket")
    direct = delays.delay_calc(plan, seen).join(bucket, "rid").groupBy("bucket").agg(
        F.count("delay").alias("n"), F.avg("delay").alias("mean"), F.var_pop("delay").alias("variance")
    )
    for a, b in zip(got.orderBy("bucket").collect(), direct.orderBy("bucket").collect()):
        assert (a.bucket, a.n) == (b.bucket, b.n)
        assert a.mean == pytest.approx(b.mean) and a.variance == pytest.approx(b.variance)


def test_private_release(spark):
    df = spark.createDataFrame([("w", "A", 5), ("w", None, 7)], "window_end string, location string, n_rids bigint")
    once, again = (sorted(r.noisy_count for r in counts.dp_noisy_count(df, "s").collect()) for _ in "ab")
    assert once == again and len(set(once)) == 2
    assert sorted(r.noisy_count for r in counts.dp_noisy_count(df, "t").collect()) != once
    fresh = counts.dp_noisy_count(df)
    assert fresh.columns == ["window_end", "location", "noisy_count"]
    sums = spark.createDataFrame([("01", 3, 12.0, 60.0)], "bucket string, n bigint, total double, squares double")
    row = delays.dp_moments(sums, "s").first()
    assert row.noisy_n != 3 and -120 <= row.noisy_mean <= 120 and 0 <= row.noisy_variance <= 120**2
    assert delays.dp_moments(sums, "s").first() == row
    near = delays.dp_moments(sums, "s", epsilon=1e9).first()
    assert (near.noisy_n, near.noisy_mean, near.noisy_variance) == pytest.approx((3, 4.0, 4.0), abs=1e-3)
