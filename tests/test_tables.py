"""Tables and archives that streams keep."""

import glob
import os
import random

from pyspark.sql import functions as F
from test_streams import Feed, _at

from feedlake.operators import delays
from feedlake.session import work_dir
from feedlake.sources import sinks
from feedlake.streaming import clock, upserts, vectors
from feedlake.streaming import jobs as streams

RECORDS = "key string, value string, offset bigint"


def _rows(df):
    return sorted(map(tuple, df.select("key", "value").collect()))


def test_upserts_in_any_order_with_deaths_and_compaction(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", clock.STATE_PROVIDER)
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(9)}", rng.choice(["a", "b", "ä\n", None]), i) for i in range(80)]
    want = {}
    for key, value, _ in rows:
        want[key] = value
    want = sorted((k, v) for k, v in want.items() if v is not None)
    stray = [(None, "x", 99), ("k1", "x", None)]
    feed, table = Feed(spark, RECORDS), upserts.UpsertTable(spark, work_dir(spark, "upserts"), buckets=3)
    assert table.state().count() == 0 and table.compact() is None
    late = rows[30:]
    rng.shuffle(late)
    for part in (late[:30] + stray, rows[:30] + late[10:20], late[30:] + rows[:5]):
        feed.deliver(part)
        table.run(feed.stream()).awaitTermination()
    assert _rows(table.state()) == want
    before = table.generations("delta")

    # A delta that never finished isn't read; the batch is run again and replaces it.
    folder = table.path.removeprefix("file:")
    last = before[-1]
    os.remove(f"{folder}/checkpoint/commits/{last}")
    os.remove(f"{folder}/checkpoint/commits/.{last}.crc")
    os.remove(f"{folder}/generation=delta-{last}/_SUCCESS")
    assert table.generations("delta") == before[:-1]
    table.run(feed.stream()).awaitTermination()
    assert table.generations("delta") == before and _rows(table.state()) == want

    assert table.compact() == last and table.compact() is None
    table.vacuum()
    assert table.generations("delta") == [] and _rows(table.state()) == want
    # What is replayed is older than the index, so it changes nothing; deleted keys stay deleted.
    feed.deliver(rows)
    feed.deliver([("k0", "new", 1000), ("k3", None, 1001)])
    table.run(feed.stream()).awaitTermination()
    want = sorted([r for r in want if r[0] not in ("k0", "k3")] + [("k0", "new")])
    assert _rows(table.state()) == want
    assert _rows(table.lookup(["k0", "k3", "none"])) == [("k0", "new")]
    new = spark.read.parquet(*(table._folder("delta", n) for n in table.generations("delta")))
    assert sorted(r.key for r in new.collect()) == ["k0", "k3"]


def test_equal_orders_give_one_result(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", clock.STATE_PROVIDER)
    found = []
    for values in (["a", "b", "c"], ["c", "a", "b"], ["b", "c", "a"]):
        feed, table = Feed(spark, RECORDS), upserts.UpsertTable(spark, work_dir(spark, "ties"), buckets=2)
        for value in values[:2]:
            feed.deliver([("k", value, 7)])
        table.run(feed.stream()).awaitTermination()
        feed.deliver([("k", values[2], 7)])
        table.run(feed.stream()).awaitTermination()
        found.append(_rows(table.state()))
    assert found[0] == found[1] == found[2]


def test_archive_files_keep_to_their_size(spark):
    rng = random.Random(3)
    texts = ["ü" * rng.choice([0, 1, 40, 400]) + "\n\"" for _ in range(600)] + ["x" * 5000, None]
    feed, base = Feed(spark, "message string, other string"), work_dir(spark, "rolled")
    for part in (texts[:250], texts[250:], ["again"]):
        feed.deliver([(t, "o") for t in part])
        query = sinks.rolling_archive(
            feed.stream(), f"{base}/out", f"{base}/checkpoint", limit=2000, trigger={"availableNow": True}
        )
        query.awaitTermination()
    got = [r.message for r in spark.read.schema("message string").json(f"{base}/out").select("message").collect()]
    assert sorted(got) == sorted([t for t in texts if t is not None] + ["again"])
    files = glob.glob(f"{base}/out/*/*/part-*".removeprefix("file:"))
    sizes = sorted(map(os.path.getsize, files))
    assert sizes[-1] > 5000 and sizes[-2] <= 2000  # the long message has a file of its own
    full = sum(1 for s in sizes if s > 1000)
    assert full >= len(sizes) / 2 and len(set(files)) == len(files)


def test_files_fill_up_across_batches_of_rows(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        lines = spark.range(0, 1000, 1, 2).select(F.rpad(F.col("id").cast("string"), 9, "x").alias("value"))
        found = {r.file: r.n for r in sinks.rolled(lines, 100).groupBy("file").agg(F.count("*").alias("n")).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert set(found.values()) == {10} and len(found) == 100


def test_state_of_vectors_goes_with_its_journey(spark):
    """Thirty days of journeys that last a day, and one that runs all the time."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", clock.STATE_PROVIDER)
    feed = Feed(spark, "rid string, event_time timestamp, tpl string, delay double")
    rows = [(f"d{day}-{k % 6}", _at(86_400 * day + 60 * k), tpl, float(day * k % 17)) for day in range(30) for k, tpl in enumerate("ABCDEFGHIJKL")]
    rows += [("always", _at(86_400 * day), None, float(day)) for day in range(30)]
    for day in range(30):
        today = [r for r in rows if (r[1] - _at(0)).days == day]
        spark.createDataFrame(today, feed.schema).coalesce(1).write.mode("append").parquet(f"{feed.base}/in")
    source = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", 1).parquet(f"{feed.base}/in")
    query = streams.to_folder(vectors.delay_vector_stream(source), f"{feed.base}/out", f"{feed.base}/checkpoint")
    query.awaitTermination()
    held = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress]
    assert len(held) >= 30 and 0 < max(held[15:]) <= max(held[:12]), held
    out = spark.read.parquet(f"{feed.base}/out")
    newest = out.groupBy("rid").agg(F.max_by("delays", F.struct("event_time", F.size("delays"))).alias("delays"))
    want = delays.delay_vector(spark.createDataFrame(rows, feed.schema)).select("rid", "delays")
    assert sorted(map(tuple, newest.collect())) == sorted(map(tuple, want.collect()))
