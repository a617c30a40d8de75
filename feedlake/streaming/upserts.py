"""An upsert table kept by a stream: deltas per batch, an index of last writers as state, and compaction.

A table is a folder of generations. ``generation=delta-N`` holds what batch ``N`` changed,
``generation=base-N`` the whole table up to and including batch ``N``; both are laid out by
buckets of the key. A generation counts once Spark has marked it as finished, so nothing of
a batch or a compaction that died is ever read, and one that is run again replaces itself.
The stream's checkpoint lies in the same folder: table and index belong together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

RECORD = "key string, value string, version bigint, digest bigint"
NAMES = [x.split()[0] for x in RECORD.split(", ")]


class _LastWriter(StatefulProcessor):
    """Per key: version and digest of its last record. A record is given out only if it comes after that one."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "version bigint, digest bigint")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        found = self.last.get()
        last = None if found is None else tuple(found)
        newer = None
        for row in rows:
            if last is None or (row.version, row.digest) > last:
                last = (row.version, row.digest)
                newer = row.value, *last
        if newer:
            self.last.update(last)
            yield Row(**dict(zip(NAMES, (*key, *newer))))

    def close(self) -> None:
        pass


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def changes(records: DataFrame, order: str = "offset") -> DataFrame:
    """Of a stream of ``key, value`` records, those that change the table; at most one per key and batch.

    The record with the highest ``order`` wins, of equal ones that with the larger digest
    of its value, in whatever order they come. A NULL value deletes its key. Records
    without key or order are dropped. The state of a key is two numbers, not its value.
    """
    rows = records.select("key", "value", F.col(order).cast("bigint").alias("version"), F.xxhash64("value").alias("digest"))
    rows = rows.filter("key IS NOT NULL AND version IS NOT NULL")
    return rows.groupBy("key").transformWithState(_LastWriter(), RECORD, "Append", "None")


class UpsertTable:
    """The table in a folder that all executors share. ``buckets`` must stay the same for its lifetime."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 32):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.path}/generation={kind}-{number}"

    def _write(self, rows: DataFrame, kind: str, number: int) -> None:
        rows = rows.withColumn("bucket", _bucket(F.col("key"), self.buckets)).repartition(self.buckets, "bucket")
        rows.write.mode("overwrite").partitionBy("bucket").parquet(self._folder(kind, number))

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        return path(self.path).getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def generations(self, kind: str) -> list[int]:
        """Numbers of the finished generations of a kind, ascending."""
        files, path = self._files()
        marks = files.globStatus(path(f"{self.path}/generation={kind}-*/_SUCCESS")) or []
        return sorted(int(m.getPath().getParent().getName().rpartition("-")[2]) for m in marks)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` step: one delta per batch of :func:`changes`."""
        self._write(batch, "delta", batch_id)

    def run(self, records: DataFrame, order: str = "offset", trigger: dict | None = None):
        """Start the stream into this table; the default trigger takes what is there and stops."""
        writer = changes(records, order).writeStream.foreachBatch(self.apply)
        writer = writer.option("checkpointLocation", f"{self.path}/checkpoint")
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    def _rows(self) -> DataFrame:
        """The newest base and the deltas after it."""
        bases = self.generations("base")[-1:]
        after = [n for n in self.generations("delta") if not bases or n > bases[0]]
        paths = [self._folder("base", n) for n in bases] + [self._folder("delta", n) for n in after]
        schema = T.StructType.fromDDL(f"{RECORD}, generation string, bucket int")
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths)

    @staticmethod
    def _last(rows: DataFrame) -> DataFrame:
        last = F.max_by(F.struct("value", "version", "digest"), F.struct("version", "digest"))
        return rows.groupBy("key").agg(last.alias("last")).select("key", "last.*")

    def state(self) -> DataFrame:
        """``key, value`` of every key that isn't deleted."""
        return self._last(self._rows()).filter("value IS NOT NULL").select("key", "value")

    def lookup(self, keys: Sequence[str]) -> DataFrame:
        """:meth:`state` of a few keys, read from their buckets alone."""
        wanted = self.spark.createDataFrame([(k,) for k in keys], "key string")
        found = {r[0] for r in wanted.select(_bucket(F.col("key"), self.buckets)).collect()}
        rows = self._rows().filter(F.col("bucket").isin(*found) & F.col("key").isin(*keys))
        return self._last(rows).filter("value IS NOT NULL").select("key", "value")

    def compact(self) -> int | None:
        """Fold all finished deltas into a new base; the number of the last one, or None if there is nothing to fold.

        Deleted keys stay as rows without value, so that an older record can't bring them
        back. The stream may go on meanwhile: what it adds has a higher number.
        """
        bases, deltas = self.generations("base"), self.generations("delta")
        if not deltas or (bases and deltas[-1] <= bases[-1]):
            return None
        upto = deltas[-1]
        older = self._rows().filter(F.substring_index("generation", "-", -1).cast("bigint") <= upto)
        self._write(self._last(older), "base", upto)
        return upto

    def vacuum(self) -> None:
        """Remove what the newest base replaces; only once nobody reads from before it."""
        bases = self.generations("base")
        if bases:
            files, path = self._files()
            for kind, numbers in (("base", bases[:-1]), ("delta", [n for n in self.generations("delta") if n <= bases[-1]])):
                for n in numbers:
                    files.delete(path(self._folder(kind, n)), True)
