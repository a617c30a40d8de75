"""Record sources. Whatever the transport, a record has at least ``value``.

Kafka sources use Spark's connector, which is a separate package
(``spark-sql-kafka-0-10``); replay sources read the JSON-lines files the file sinks
write and serve tests, back-fills and re-runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Topics between the jobs.
RAW, SCHEDULE, STATUS, JOINED = "rail_network", "rtti-schedule", "rtti-ts", "rtti-joined"
SIGNATURES, SIMILARITY = "rtti-lsh-signature", "rtti-lsh-similarity"
BLOOM, COUNTS = "rtti-bloomfilter-results", "rtti-dp-location-counts"

TEXT_LINES = T.StructType([T.StructField("value", T.StringType())])


def kafka_options(servers: str, topic: str, starting: str = "latest", **consumer: str) -> dict[str, str]:
    """Reader options; ``consumer`` settings pass through, with ``_`` for ``.``."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    options |= {f"kafka.{name.replace('_', '.')}": value for name, value in consumer.items()}
    return options


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest", **consumer: str) -> DataFrame:
    """Unbounded topic."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting, **consumer)).load()


def kafka_table(spark: SparkSession, servers: str, topic: str, **consumer: str) -> DataFrame:
    """Everything a topic holds now."""
    return spark.read.format("kafka").options(**kafka_options(servers, topic, "earliest", **consumer)).load()


def replay_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines or text files as an unbounded source, one record per line."""
    reader = spark.readStream.schema(TEXT_LINES)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path)


def replay_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TEXT_LINES).text(path)


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table folder, or a table kept as one file, as an unbounded source.

    A streaming source takes a plain path for a folder; as a pattern it matches both.
    The path itself must hold no pattern characters.
    """
    path = path.rstrip("/")
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def raw_messages(records: DataFrame) -> DataFrame:
    """Record values as UTF-8 text, one ``message`` per record."""
    return records.select(F.col("value").cast("string").alias("message"))
