"""Record sinks. The shaping functions are plain projections; the writers add transport."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

ROLL_INTERVAL = "10 minutes"
# Upper bound per archive file; with feed messages of a few KB about 128 MB.
ROLL_RECORDS = 50_000
# Bytes of an archive file that is rolled by size.
ROLL_BYTES = 128 * 1024 * 1024


def kafka_value(df: DataFrame) -> DataFrame:
    """Whole row as a JSON ``value``, no key."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def keyed(df: DataFrame, key: str = "rid") -> DataFrame:
    """Key text plus JSON value: one journey stays in one topic partition."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def upsert(df: DataFrame, key: Sequence[str] = ("rid", "window_end")) -> DataFrame:
    """JSON key of the primary key plus JSON value; readers keep the last value per key."""
    value = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    return df.select(F.to_json(F.struct(*key)).alias("key"), value.alias("value"))


def last_per_key(records: DataFrame, order: str | Column = "offset") -> DataFrame:
    """Current state of an upsert topic: the value with the highest order per key."""
    return records.groupBy("key").agg(F.max_by("value", order).alias("value"))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def write_archive(messages: DataFrame, path: str, column: str = "message", roll: int = ROLL_RECORDS) -> None:
    """Batch archive: non-NULL messages as JSON lines, files bounded by record count."""
    kept = not_null(messages.select(column), column)
    kept.write.mode("append").option("maxRecordsPerFile", roll).json(path)


def archive_stream(
    messages: DataFrame, path: str, checkpoint: str, column: str = "message", trigger: Mapping | None = None
) -> StreamingQuery:
    """Streaming archive: JSON lines, a new set of files per trigger."""
    kept = not_null(messages.select(column), column)
    writer = kept.writeStream.format("json").option("path", path).option("checkpointLocation", checkpoint)
    writer = writer.option("maxRecordsPerFile", ROLL_RECORDS)
    return writer.trigger(**(trigger or {"processingTime": ROLL_INTERVAL})).start()


def rolled(lines: DataFrame, limit: int = ROLL_BYTES) -> DataFrame:
    """``value`` lines with the ``file`` each goes to: a task fills one after the other up to ``limit`` bytes.

    Sizes are those of the encoded lines with their line ends. A line beyond the limit has
    a file of its own. Nothing is shuffled; a task remembers two numbers.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, file, filled = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column(0)).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            names, start = [], 0
            while start < len(ends):
                before = int(ends[start - 1]) if start else 0
                end = int(np.searchsorted(ends, before + limit - filled, "right"))
                if end == start and filled == 0:
                    end += 1
                names += [f"f{task}-{file}"] * (end - start)
                filled += int(ends[end - 1]) - before if end > start else 0
                if end < len(ends):
                    file, filled = file + 1, 0
                start = end
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string())], ["value", "file"])

    return lines.select("value").mapInArrow(number, "value string, file string")


def archive_batch(path: str, column: str = "message", limit: int = ROLL_BYTES):
    """A ``foreachBatch`` step: non-NULL messages as JSON lines in files of at most ``limit`` bytes.

    A batch has a folder of its own and closes all its files, so none is open longer than
    a batch takes; one that is run again replaces itself.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = not_null(batch, column).select(F.to_json(F.struct(column)).alias("value"))
        rolled(lines, limit).write.mode("overwrite").partitionBy("file").text(f"{path}/batch_id={batch_id}")

    return write


def rolling_archive(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    column: str = "message",
    limit: int = ROLL_BYTES,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Streaming archive whose files are closed by size within a batch, and by time with it."""
    writer = messages.select(column).writeStream.option("checkpointLocation", checkpoint)
    writer = writer.foreachBatch(archive_batch(path, column, limit))
    return writer.trigger(**(trigger or {"processingTime": ROLL_INTERVAL})).start()


def text_stream(
    messages: DataFrame, path: str, checkpoint: str, column: str = "message", trigger: Mapping | None = None
) -> StreamingQuery:
    """Streaming archive of the bare messages, one per line."""
    lines = not_null(messages.select(F.col(column).alias("value")), "value")
    writer = lines.writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": ROLL_INTERVAL})).start()


def kafka_stream_sink(records: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    """Writer of (key,) value records to a topic."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "checkpointLocation": checkpoint}
    return records.writeStream.format("kafka").options(**options)


def console_sink(df: DataFrame, checkpoint: str) -> DataStreamWriter:
    """Debug output; rows are shown, never collected as a whole."""
    return df.writeStream.format("console").option("checkpointLocation", checkpoint)


def table_batch(path: str):
    """A ``foreachBatch`` step that keeps one folder per batch, so that a retried batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def fan_out(*steps):
    """A ``foreachBatch`` step that computes a batch once and hands it to several writers."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for step in steps:
                step(batch, batch_id)
        finally:
            batch.unpersist()

    return write


def multi_sink(
    df: DataFrame, steps, checkpoint: str, mode: str = "append", trigger: Mapping | None = None
) -> StreamingQuery:
    """One streaming result into several sinks; each sink sees every batch at least once."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(fan_out(*steps)).trigger(**(trigger or {"availableNow": True})).start()
