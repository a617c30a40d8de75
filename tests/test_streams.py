import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedlake.operators import counts, joins, sketches
from feedlake.session import work_dir
from feedlake.sources import sinks, topics
from feedlake.streaming import jobs as streams
from feedlake.streaming import vectors

START = datetime(2025, 4, 30, 12, 0, 0)
JOINED = "rid string, event_time timestamp, sch_tpl string, ts_tpl string, event_type string"
SIDE = "rid string, event_time timestamp, uid string, tpl string, wta string, wtd string, wtp string"
STATUS = SIDE + ", pta string, ptd string, event_type string, actual_time string"


def _at(seconds):
    return START + timedelta(seconds=seconds)


class Feed:
    """A folder that receives batches, and a stream over it that is drained after each."""

    def __init__(self, spark, schema):
        self.spark, self.base = spark, work_dir(spark, "feed")
        self.schema = spark.createDataFrame([], schema).schema

    def deliver(self, rows):
        self.spark.createDataFrame(rows, self.schema).write.mode("append").parquet(f"{self.base}/in")

    def stream(self):
        return topics.parquet_stream(self.spark, f"{self.base}/in", self.schema)

    def drained(self, df):
        streams.drain(df, f"{self.base}/out", f"{self.base}/checkpoint")
        return self.spark.read.schema(df.schema).parquet(f"{self.base}/out")


def _visits():
    return [
        (f"j{k % 3}", _at(7 * k), "A" if k % 2 else None, f"T{k % 4}", ("arr", "dep", "pass", "none")[k % 4])
        for k in range(40)
    ] + [(None, _at(3), "A", "T1", "arr")]


def test_streams_equal_batch_once_windows_close(spark):
    feed = Feed(spark, JOINED)
    rows = _visits()
    feed.deliver(rows)
    feed.deliver([("end", _at(3600), "A", "T0", "arr")])  # moves the watermark past all windows
    batch = spark.createDataFrame(rows, JOINED)
    window_rows = batch.filter("rid IS NOT NULL").withColumn(
        "window_end", F.date_format(F.window("event_time", "1 minute")["end"], "yyyy-MM-dd HH:mm:ss.SSS")
    )
    keys = ["rid", "window_end"]

    assert sorted(feed.drained(streams.minhash_stream(feed.stream())).collect()) == sorted(
        sketches.minhash_signature(window_rows, keys).collect()
    )
    other = Feed(spark, JOINED)
    other.base, feed_base = other.base, feed.base
    stream = streams.bloom_stream(feed.stream())
    assert sorted(other.drained(stream).collect()) == sorted(sketches.bloom_filter(window_rows, keys).collect())
    third = Feed(spark, JOINED)
    got = third.drained(streams.count_stream(feed.stream()))
    assert sorted(got.collect()) == sorted(counts.distinct_count_window(batch).collect())
    assert feed_base == feed.base


def test_null_location_is_a_group(spark):
    rows = [("a", _at(1), "A", None, "arr"), ("b", _at(2), "A", None, "arr"), ("b", _at(3), "A", None, "dep")]
    got = counts.distinct_count_window(spark.createDataFrame(rows, JOINED)).collect()
    assert [(r.window_end, r.location, r.n_rids) for r in got] == [("2025-04-30 12:01:00.000", None, 2)]


def test_late_rows_are_dropped(spark):
    feed = Feed(spark, JOINED)
    totals = None
    for batch in (
        [("a", _at(10), "A", "T", "arr"), ("a", _at(70), "A", "T", "arr"), ("a", _at(200), "A", "T", "arr")],
        [("a", _at(210), "A", "T", "arr")],
        [("late", _at(15), "A", "T", "arr"), ("late", _at(80), "A", "T", "arr"), ("b", _at(190), "A", "T", "arr")],
        [("a", _at(900), "A", "T", "arr")],
    ):
        feed.deliver(batch)
        totals = feed.drained(streams.count_stream(feed.stream()))
    assert sorted((r.window_end[11:16], r.n_rids) for r in totals.collect()) == [
        ("12:01", 1), ("12:02", 1), ("12:04", 2),
    ]


@pytest.mark.parametrize("slices", [1, 3])
def test_window_join_stream_equals_batch(spark, slices):
    plan = [(f"j{k % 3}", _at(5 * k), "U", f"S{k}", "10:00", None, None) for k in range(20)]
    seen = [
        (f"j{k % 4}", _at(4 * k), None, f"T{k}", None, None, None, "9:59", None, "arr", None) for k in range(25)
    ]
    left, right = Feed(spark, SIDE), Feed(spark, STATUS)
    left.deliver(plan)
    right.deliver(seen)
    stream = streams.join_stream(left.stream(), right.stream(), slices=slices).drop("win")
    batch = joins.window_join(spark.createDataFrame(plan, SIDE), spark.createDataFrame(seen, STATUS)).drop("win")
    got = left.drained(stream).collect()
    assert sorted(got) == sorted(batch.collect())
    expected = sum(
        p[0] == s[0] and (p[1] - START).seconds // 30 == (s[1] - START).seconds // 30 for p in plan for s in seen
    )
    assert len(got) == expected > 0
    assert {r.sch_wtd for r in got} == {"null"} and {r.ts_pta for r in got} == {"9:59"}


def test_features_are_the_distinct_join(spark):
    plan = [("j", _at(1), "U", f"S{k % 2}", None, None, None) for k in range(6)]
    seen = [("j", _at(2), None, f"T{k % 3}", None, None, None, None, None, "arr", None) for k in range(9)]
    sides = spark.createDataFrame(plan, SIDE), spark.createDataFrame(seen, STATUS)
    names = ["rid", "sch_tpl", "ts_tpl", "event_type"]
    features = joins.journey_features(*sides).select(*names)
    assert sorted(features.collect()) == sorted(joins.window_join(*sides).select(*names).distinct().collect())
    assert features.count() == 6
    assert joins.window_join(*sides).count() == joins.window_join(*sides, slices=4).count() == 54
    kept = joins.window_join(*sides, null_text=None).first()
    assert kept.ts_wta is None


def test_joined_record_is_valid_json(spark):
    plan = [("j", _at(1), 'U"1', "S", None, None, None)]
    seen = [("j", _at(2), None, "T\\", None, None, None, None, None, "arr", None)]
    joined = joins.window_join(spark.createDataFrame(plan, SIDE), spark.createDataFrame(seen, STATUS))
    record = json.loads(joins.joined_record(joined).first().value)
    assert (record["uid"], record["ts_tpl"], record["actual_time"]) == ('U"1', "T\\", "null")
    assert len(record) == 14


def test_hot_journey_is_split_by_the_join(spark):
    """A third of all rows in one window-journey: adaptive execution cuts its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(0, 30_000, 1, 8)
        rid = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("j"), F.col("id").cast("string")))
        seen = ids.select(
            rid.alias("rid"),
            F.timestamp_seconds(F.lit(1746014400) + F.col("id") % 10).alias("event_time"),
            F.md5(F.col("id").cast("string")).alias("tpl"),
            *[F.lit(None).cast("string").alias(c) for c in ("pta", "ptd", "wta", "wtd", "wtp")],
            F.lit("arr").alias("event_type"),
            F.lit("x").alias("actual_time"),
        )
        plan = seen.select("rid", "event_time", F.lit("U").alias("uid"), "tpl", "wta", "wtd", "wtp")
        plan = plan.filter("rid <> 'hot'").unionByName(plan.filter("rid = 'hot'").limit(1))
        joined = joins.window_join(plan, seen)
        rows = joined.collect()
        assert len(rows) == 30_000
        final = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in final
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@pytest.mark.parametrize("slices", [1, 3])
def test_similarity_stream_equals_batch(spark, slices):
    from feedlake import schemas
    from feedlake.operators.similar import similar_pairs

    rows = [(f"j{k}", f"2025-04-30 12:0{k % 2}:00.000", [k % 3, 1, None, k % 2, 4]) for k in range(10)]
    later = [("end", "2025-04-30 13:00:00.000", [0])]
    df = spark.createDataFrame(rows, schemas.SIGNATURE)
    base = work_dir(spark, "sig")
    df.unionByName(spark.createDataFrame(later, schemas.SIGNATURE)).write.parquet(f"{base}/in")
    source = topics.parquet_stream(spark, f"{base}/in", df.schema)
    stream = streams.similarity_stream(source, 0.6, slices=slices)
    streams.drain(stream, f"{base}/out", f"{base}/checkpoint")
    got = spark.read.schema(stream.schema).parquet(f"{base}/out")
    want = similar_pairs(df, 0.6).collect()
    assert sorted(got.collect()) == sorted(want) and want


def test_delay_vector_stream_over_several_batches(spark):
    from feedlake.operators import delays

    schema = "rid string, tpl string, event_time timestamp, delay double"
    feed = Feed(spark, schema)
    rows = [(f"j{k % 3}", f"T{k}", _at((k * 37) % 500), float(k)) for k in range(40)]
    for part in (rows[:15], rows[15:18], rows[18:]):
        feed.deliver(part)
        out = feed.drained(vectors.delay_vector_stream(feed.stream()))
    final = {}
    for r in sorted(out.collect(), key=lambda r: (r.event_time, len(r.delays))):
        final.setdefault(r.rid, []).append(r.delays)
    batch = {r.rid: r.delays for r in delays.delay_vector(spark.createDataFrame(rows, schema)).collect()}
    assert all(batch[rid] in seen for rid, seen in final.items()) and set(final) == set(batch)


def test_arrival_time(spark):
    feed = Feed(spark, JOINED)
    feed.deliver(_visits())
    stream = streams.bloom_stream(feed.stream(), time="arrival")
    query = stream.writeStream.outputMode("update").format("memory").queryName("arrivals")
    query.option("checkpointLocation", f"{feed.base}/arrival").trigger(availableNow=True).start().awaitTermination()
    # window of the run itself, not of the records
    assert spark.table("arrivals").filter("window_end < '2025-05-01'").count() == 0
    with pytest.raises(ValueError):
        streams.timed(feed.stream(), time="other")


# --- sinks and sources -----------------------------------------------------------------


def test_fan_out_gives_both_sinks_the_same_rows_and_survives_a_retry(spark):
    base = work_dir(spark, "sinks")
    steps = [sinks.table_batch(f"{base}/{n}") for n in "ab"]
    write = sinks.fan_out(*steps)
    batch = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    write(batch, 0)
    write(batch, 0)  # the same batch again
    got = [sorted(tuple(r) for r in spark.read.parquet(f"{base}/{n}").select("k", "v").collect()) for n in "ab"]
    assert got[0] == got[1] == [(1, "x"), (2, "y")]
    assert not batch.is_cached


def test_record_shapes(spark):
    df = spark.createDataFrame([("r", "w", None)], "rid string, window_end string, v string")
    assert json.loads(sinks.kafka_value(df).first().value) == {"rid": "r", "window_end": "w", "v": None}
    row = sinks.upsert(df).first()
    assert json.loads(row.key) == {"rid": "r", "window_end": "w"} and json.loads(row.value)["v"] is None
    assert sinks.keyed(df).first().key == "r"
    log = spark.createDataFrame([("k", "old", 1), ("k", "new", 2), ("m", "x", 0)], "key string, value string, offset long")
    assert sorted(tuple(r) for r in sinks.last_per_key(log).collect()) == [("k", "new"), ("m", "x")]


def test_archives(spark):
    base = work_dir(spark, "archives")
    messages = spark.createDataFrame([("a",), (None,), ("b\nc",), ("d",)], "message string")
    sinks.write_archive(messages, f"{base}/batch", roll=1)
    stored = spark.read.json(f"{base}/batch")
    assert sorted(r.message for r in stored.collect()) == ["a", "b\nc", "d"]
    assert len(stored.inputFiles()) >= 3
    messages.filter("message <> 'b\nc'").write.parquet(f"{base}/in")
    source = topics.parquet_stream(spark, f"{base}/in", messages.schema)
    now = {"availableNow": True}
    sinks.archive_stream(source, f"{base}/json", f"{base}/c1", trigger=now).awaitTermination()
    sinks.text_stream(source, f"{base}/text", f"{base}/c2", trigger=now).awaitTermination()
    assert sorted(r.message for r in spark.read.json(f"{base}/json").collect()) == ["a", "d"]
    assert sorted(r.message for r in topics.raw_messages(topics.replay_table(spark, f"{base}/text")).collect()) == ["a", "d"]


def test_kafka_options():
    """Only the options: the connector is a separate package and not installed here."""
    got = topics.kafka_options("host:9093", topics.RAW, "earliest", group_id="g", max_poll_records="500")
    assert got == {
        "kafka.bootstrap.servers": "host:9093",
        "subscribe": "rail_network",
        "startingOffsets": "earliest",
        "kafka.group.id": "g",
        "kafka.max.poll.records": "500",
    }


def test_work_dir_needs_a_shared_folder():
    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Context:
        def __init__(self, folder):
            self.folder = folder

        def getCheckpointDir(self):  # noqa: N802
            return self.folder

    class Session:
        def __init__(self, folder=None, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})
            self.sparkContext = Context(folder)

    assert work_dir(Session(spark_checkpoint_dir="s3://b/x/"), "l").startswith("s3://b/x/feedlake/l-")
    assert work_dir(Session("s3://c"), "l").startswith("s3://c/feedlake/l-")
    for master in ("yarn", "local[2]"):
        with pytest.raises(ValueError):
            work_dir(Session(spark_master=master), "l")


def test_stream_of_a_folder_with_a_final_slash(spark):
    base, out = work_dir(spark, "table"), work_dir(spark, "out")
    spark.range(3).write.parquet(base)
    stream = topics.parquet_stream(spark, base + "/", spark.range(1).schema)
    streams.drain(stream, f"{out}/rows", f"{out}/checkpoint")
    assert spark.read.parquet(f"{out}/rows").count() == 3
