"""Windows that close by the clock: a window is given out when its time is over, whether or not more records come."""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from feedlake.functions.expressions import window_text
from feedlake.operators import counts

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTIAL = "ends_at bigint, location string, n_rids bigint"


class _DistinctPerWindow(StatefulProcessor):
    """Distinct journeys of one key by arrival window: a map of (window end, journey), a timer per window."""

    def __init__(self, window_ms: int):
        self.window_ms = window_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "ends_at bigint, rid string", "n int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ends_at = (timerValues.getCurrentProcessingTimeInMs() // self.window_ms + 1) * self.window_ms
        for batch in rows:
            for rid in batch["rid"].unique().tolist():
                self.seen.updateValue((ends_at, rid), (1,))
        self.handle.registerTimer(ends_at)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        ends_at = expiredTimerInfo.getExpiryTimeInMs()
        closed = [k for k in self.seen.keys() if k[0] <= ends_at]
        for k in closed:
            self.seen.removeKey(k)
        if closed:
            yield pd.DataFrame({"ends_at": [ends_at], "location": [key[0]], "n_rids": [len(closed)]})

    def close(self) -> None:
        pass


def arrival_count_stream(
    joined: DataFrame,
    window_ms: int = 60_000,
    event_types: Sequence[str] = counts.VISIT_EVENTS,
    location: str = "ts_tpl",
    slices: int = 1,
) -> DataFrame:
    """``window_end, location, n_rids``: distinct journeys per location and window of arrival.

    A window spans ``window_ms`` of the clock of the micro-batches; its timer fires at its
    end. With ``slices``, a busy location is counted in that many parts by journey, one row
    each; a journey is in one part only, so the parts of a window add up.
    """
    part = F.pmod(F.xxhash64("rid"), F.lit(slices)).cast("int").alias("part")
    visits = counts.relevant(joined, event_types).select(F.col(location).alias("location"), "rid", part)
    found = visits.groupBy("location", "part").transformWithStateInPandas(
        _DistinctPerWindow(window_ms), PARTIAL, "Append", "ProcessingTime"
    )
    return found.select(window_text(F.timestamp_millis("ends_at")).alias("window_end"), "location", "n_rids")


def run_until_idle(stream: DataFrame, path: str, checkpoint: str, poll: float = 0.5, limit: float = 600.0) -> None:
    """Run a stream with timers into a Parquet folder until it read nothing more and holds no state."""
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    query = writer.option("checkpointLocation", checkpoint).trigger(processingTime="500 milliseconds").start()
    deadline = time.monotonic() + limit
    try:
        while not _idle(query):
            if query.exception():
                raise query.exception()
            if time.monotonic() > deadline:
                raise TimeoutError(f"the stream was not idle within {limit:.0f} seconds")
            time.sleep(poll)
    finally:
        query.stop()


def _idle(query: StreamingQuery) -> bool:
    """Whether a batch without input has followed one with input, and no state is left."""
    recent = query.recentProgress
    read = [p.batchId for p in recent if p.numInputRows]
    last = recent[-1] if recent else None
    held = sum(s.numRowsTotal for s in last.stateOperators) if last else 1
    return bool(read) and last.batchId > read[-1] and held == 0
