"""Settled tables: intermediate results as Parquet in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    Where it is unset, the context's checkpoint directory is taken; a local session
    without either gets one of its own, any other session is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        sc.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='llm-')}")
    return sc.getCheckpointDir().rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nobody has used."""
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table.

    It is computed once however often it is read, and a lost executor costs a read,
    not the lineage.
    """
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
