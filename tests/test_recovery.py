"""Streams that die at three points of a batch and give the rows of their batch twins, once."""

import random
from datetime import timedelta

import pytest
from faults import POINTS, FaultySink
from test_streams import JOINED, SIDE, START, STATUS, _at

from feedlake import schemas
from feedlake.operators import counts, joins
from feedlake.operators.similar import similar_pairs
from feedlake.plans import jobs
from feedlake.session import work_dir
from feedlake.streaming import batches as folders
from feedlake.streaming import pairs
from feedlake.streaming import jobs as streams

DELAY = "10 minutes"


class Slow:
    """A folder that is read one delivery at a time."""

    def __init__(self, spark, schema, *deliveries):
        self.spark, self.base = spark, work_dir(spark, "slow")
        self.schema = spark.createDataFrame([], schema).schema
        for rows in deliveries:
            spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(f"{self.base}/in")

    def __call__(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(f"{self.base}/in")


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def _survives(spark, make, want, newest=None):
    """The rows of a stream that dies three times are those wanted."""
    sink = FaultySink(work_dir(spark, "faulty"))
    schema = sink.run(make)
    assert [point for _, point in sink.deaths] == list(POINTS)
    got = sink.rows(spark, schema)
    got = newest(got) if newest else got
    assert _rows(got) == _rows(want.select(*got.columns)) != []


def _features(seed=3):
    rng = random.Random(seed)
    rows = [
        (f"j{rng.randrange(6)}", _at(rng.randrange(200)), rng.choice([None, "A", "B"]), f"T{rng.randrange(4)}", rng.choice(["arr", "dep", "none"]))
        for _ in range(90)
    ]
    return rows, [("end", START + timedelta(days=1), "A", "T0", "arr")]


@pytest.mark.parametrize("name", ["minhash", "bloom", "counts"])
def test_window_streams(spark, name):
    rows, end = _features()
    source, batch = Slow(spark, JOINED, rows[:45], rows[45:], end), spark.createDataFrame(rows, JOINED)
    make, want = {
        "minhash": (lambda: streams.minhash_stream(source(), delay=DELAY), jobs.signatures(batch)),
        "bloom": (lambda: streams.bloom_stream(source(), delay=DELAY), jobs.bloom_filters(batch)),
        "counts": (lambda: streams.count_stream(source(), delay=DELAY), counts.distinct_count_window(batch)),
    }[name]
    _survives(spark, make, want)


def _sides(seed=4):
    rng = random.Random(seed)
    plan = [(f"j{k % 5}", _at(rng.randrange(120)), "U", f"S{k % 3}", "12:01", None, None) for k in range(40)]
    seen = [(f"j{k % 5}", _at(rng.randrange(120)), None, f"S{k % 3}", "12:01", None, None, None, None, "arr", f"12:{k % 60:02d}") for k in range(40)]
    end = ("end", START + timedelta(days=1), "U", "S", None, None, None)
    return plan, seen, [end], [("last", *end[1:], None, None, "arr", None)]


def test_window_join(spark):
    plan, seen, *ends = _sides()
    left = Slow(spark, SIDE, plan[:20], plan[20:], ends[0])
    right = Slow(spark, STATUS, seen[:20], seen[20:], ends[1])
    want = joins.window_join(spark.createDataFrame(plan, SIDE), spark.createDataFrame(seen, STATUS))
    _survives(spark, lambda: streams.join_stream(left(), right(), delay=DELAY), want)


def _signatures(spark, hot=120):
    """Journeys of two windows, in every second one the same value at one position."""
    rng = random.Random(9)
    ends = [f"2025-04-30 12:0{k}:00.000" for k in (1, 2)]
    rows = [
        (f"j{k}", ends[w], [7 if k % 2 else rng.randrange(900), *(rng.randrange(40) for _ in range(9))])
        for w in range(2) for k in range(hot)
    ]
    rng.shuffle(rows)
    return rows, [("end", "2025-05-01 12:00:00.000", [-1])]


def test_window_pairs(spark):
    rows, end = _signatures(spark)
    half = [r for r in rows if r[1].endswith("12:01:00.000")], [r for r in rows if not r[1].endswith("12:01:00.000")]
    late = [("late", half[0][0][1], half[0][0][2])]
    source = Slow(spark, schemas.SIGNATURE, half[0], half[1], late + end)
    base = work_dir(spark, "window-pairs")
    search = pairs.WindowPairs(spark, base, threshold=0.2, delay_seconds=60, slice_rows=16)
    sink = FaultySink(base, batches=(0, 1, 1), step=search.apply, marked=f"{base}/progress")
    sink.run(source)
    assert [point for _, point in sink.deaths] == list(POINTS)
    want = similar_pairs(spark.createDataFrame(rows, schemas.SIGNATURE), 0.2, scratch=work_dir(spark, "pairs"))
    brute = {
        (a[1], *sorted((a[0], b[0]))) for a in rows for b in rows
        if a[0] < b[0] and a[1] == b[1] and sum(x == y for x, y in zip(a[2], b[2])) >= 2
    }
    got = search.result()
    assert _rows(got) == _rows(want.select(*got.columns))
    assert {(r.window_end, r.rid1, r.rid2) for r in got.collect()} == brute != set()
    search.vacuum()
    assert folders.finished(spark, f"{base}/waiting") == [2] and _rows(search.result()) == _rows(got)


def test_window_pairs_without_rows(spark):
    search = pairs.WindowPairs(spark, work_dir(spark, "window-pairs"))
    assert search.result().collect() == []
    search.apply(spark.createDataFrame([], schemas.SIGNATURE), 0)
    search.apply(spark.createDataFrame([(None, None, None), ("a", "no time", [1]), (None, "2025-04-30 12:01:00.000", [])], schemas.SIGNATURE), 1)
    search.apply(spark.createDataFrame([("end", "2025-05-01 12:00:00.000", [1])], schemas.SIGNATURE), 2)
    assert search.result().collect() == []
