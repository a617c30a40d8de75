"""Session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings the plans rely on at scale. AQE coalesces small shuffle partitions and
# splits skewed ones in joins; forcing the skew split keeps it when a later
# operator could have reused the join's partitioning. The small per-group sets of
# the sketches fit a hash map well beyond the default of 128 groups, and their rows
# are small but costly, so few bytes are still worth a task of their own. Days and
# clocks are UTC. A JSON object with a repeated key keeps the last value. RocksDB
# keeps streaming state off the JVM heap. What a Python worker gets at once is bounded by
# bytes, as message bodies may be long.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "4096",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app: str = "feedlake", master: str | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``extra`` entries override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, else the context's checkpoint directory."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return base.rstrip("/")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder in the shared one, for checkpoints and intermediate tables."""
    return f"{shared_folder(spark)}/feedlake/{label}-{uuid.uuid4().hex}"
