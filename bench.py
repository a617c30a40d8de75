"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_SHARED_DIR`` the
folder for intermediate tables (else a new temporary one); names given as
arguments replace the headline list. Each query runs once to the end, into a sink
that discards its rows.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from feedlake.plans.registry import QUERIES
from feedlake.session import build_session

HEADLINE = (
    "feed_pipeline",
    "flatten_ts",
    "flatten_schedule",
    "parse_keyed_json",
    "window_join",
    "journey_features",
    "minhash_signature",
    "similarity_pairs",
    "journey_similarity",
    "bloom_agg",
    "bloom_might_contain",
    "distinct_count_window",
    "dp_noisy_count",
    "delay_vector",
    "bucket_moments",
    "lsh_bucket",
    "stream_window_join",
    "stream_minhash",
    "stream_dp_count",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = os.environ.get("BENCH_SHARED_DIR") or tempfile.mkdtemp(prefix="bench-")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.checkpoint.dir": f"file://{os.path.abspath(shared)}",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    seconds: dict[str, float] = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    result = {
        "metric": "headline queries, total time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
