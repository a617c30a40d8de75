"""The pair queries on journeys of which most are copies: every pair of journeys is a row of its own."""

from datetime import datetime
from itertools import combinations

import __spark_entry__ as entry
import duckdb
import pytest

from feedlake.operators.similar import similar_pairs

QUERIES = ["similarity_pairs", "journey_similarity", "stream_window_pairs", "stream_similarity", "stream_chain"]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("copies"))
    rows = []
    for user in range(1, 8):
        own = [("signup", 12.0), ("click", 33.0), ("view", 71.0), ("error", 140.0)]
        if user > 5:  # alike, not equal
            own[3] = ("error", 222.0 + user * 50)
        for day in (1, 2):
            rows += [(user * 10 + k, datetime(2024, 1, day, 8, k), user, kind, value, "") for k, (kind, value) in enumerate(own)]
    names = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    spark.createDataFrame(rows, names).coalesce(1).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", QUERIES)
def test_copies_pair_with_all_others(spark, table, name):
    got = sorted(map(tuple, entry.queries()[name](spark, table).select("window_end", "rid1", "rid2", "similarity").collect()))
    wanted = [(str(a), str(b)) for a, b in combinations(range(1, 8), 2)]
    assert [(w, a, b) for w, a, b, _ in got] == [(f"2024-01-0{d} 00:00:00.000", *p) for d in (2, 3) for p in wanted]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{table}/events.parquet/*.parquet'")
    assert sorted(con.execute(entry.oracle_sql()[name]).fetchall()) == got


def test_nulls_hold_their_place(spark):
    rows = [("a", [0, 3, None, 3]), ("b", [0, None, 3, 3]), ("c", [None, 3, None, 3])]
    df = spark.createDataFrame([(r, "w", s) for r, s in rows], "rid string, window_end string, minhash_signature array<bigint>")
    got = sorted(map(tuple, similar_pairs(df, 0.1).collect()))
    assert got == [("w", "a", "b", 0.5), ("w", "a", "c", 0.5), ("w", "b", "c", 0.25)]
