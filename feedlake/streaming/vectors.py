"""Delay vectors as a stream whose state leaves with its journey."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from feedlake.operators import delays as d
from feedlake.operators import joins

VECTORS = "rid string, at bigint, delays array<double>"
#: A journey without a row for this long is over.
LIFETIME = "2 days"
#: Expiry times are rounded up to this many milliseconds.
TICK_MS = 60_000


def _order(row: tuple) -> tuple:
    at, tpl, delay = row
    return at, tpl is not None, tpl or "", delay


class _Vector(StatefulProcessor):
    """Per journey: its last rows, and the time at which they are looked at again.

    A journey has one timer at a time. Where newer rows have come meanwhile, it is set
    anew; otherwise the state goes.
    """

    def __init__(self, length: int, lifetime_ms: int):
        self.length, self.lifetime_ms = length, lifetime_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kept = handle.getValueState("kept", "at array<bigint>, tpl array<string>, delay array<double>")

    def _due(self, at: int) -> int:
        return -(-(at // 1000 + self.lifetime_ms) // TICK_MS) * TICK_MS

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.kept.exists()
        last = list(zip(*self.kept.get())) if known else []
        for batch in rows:
            new = batch[["at", "tpl", "delay"]].itertuples(index=False)
            new = [(int(at), tpl if isinstance(tpl, str) else None, float(delay)) for at, tpl, delay in new]
            last = sorted(last + new, key=_order)[-self.length :]
        at, tpl, delay = map(list, zip(*last))
        self.kept.update((at, tpl, delay))
        if not known:
            self.handle.registerTimer(self._due(at[-1]))
        yield pd.DataFrame({"rid": [key[0]], "at": [at[-1]], "delays": [delay]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = self._due(self.kept.get()[0][-1])
        if due > expiredTimerInfo.getExpiryTimeInMs():
            self.handle.registerTimer(due)
        else:
            self.kept.clear()
        return iter([])

    def close(self) -> None:
        pass


def delay_vector_stream(
    delays: DataFrame, length: int = d.VECTOR_LENGTH, lifetime: str = LIFETIME, delay: str = joins.WATERMARK
) -> DataFrame:
    """:func:`delays.delay_vector` on a stream: per micro-batch, the new vector of each journey it touched.

    The state of a journey is its last ``length`` rows, so late rows fall into place.
    It goes once the watermark is ``lifetime`` past the newest of them; a row that comes
    still later begins a new vector. Rows arrive batch by batch and are folded, never
    gathered. Rows without time or delay are dropped.
    """
    rows = delays.filter("event_time IS NOT NULL AND delay IS NOT NULL").withWatermark("event_time", delay)
    # Time goes along as a number: a closing record's year is beyond what a Pandas timestamp holds.
    rows = rows.withColumn("at", F.unix_micros("event_time")).select("rid", "at", "tpl", "delay")
    step = _Vector(length, int(pd.Timedelta(lifetime).total_seconds() * 1000))
    vectors = rows.groupBy("rid").transformWithStateInPandas(step, VECTORS, "Append", "EventTime")
    return vectors.select("rid", F.timestamp_micros("at").alias("event_time"), "delays")
