"""Delays of a status stream against a schedule stream: the plan is state, kept in versions."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from feedlake.operators import delays, joins

MET = "rid string, tpl string, at bigint, event_type string, reported_time string, wta string, wtd string, wtp string"
MET_NAMES = [x.split()[0] for x in MET.split(", ")]
#: Timers of a key are set this far apart, in milliseconds of event time.
TICK_MS = 60_000
#: Rows of a key that wait for one call of its state.
HELD = 1024


def _larger(one: tuple, other: tuple) -> tuple:
    """The larger of two rows of times; a missing time is the smallest."""
    return max(one, other, key=lambda times: [(t is not None, t or "") for t in times])


class _AsOf(StatefulProcessor):
    """Per journey and location: versions of the plan by their time, and status rows that wait for the watermark.

    A status row is measured once no earlier schedule row can come any more, against the
    version in force at its own time. Versions that a later one has replaced before the
    watermark go. A key has a timer for the first of its rows alone; when that is due, the
    rows that the watermark has passed are done together and the next one gets a timer.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.versions = handle.getMapState("versions", "at bigint", "wta string, wtd string, wtp string")
        self.waiting = handle.getListState("waiting", "at bigint, event_type string, reported_time string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        waiting, first, planned = [], None, {}
        for row in rows:
            if row.plan:
                times = (row.wta, row.wtd, row.wtp)
                planned[row.at] = _larger(times, planned[row.at]) if row.at in planned else times
                if len(planned) == HELD:
                    self._keep(planned)
            else:
                waiting.append((row.at, row.event_type, row.reported_time))
                if len(waiting) == HELD:
                    self.waiting.appendList(waiting)
                    waiting.clear()
            first = row.at if first is None else min(first, row.at)
        self._keep(planned)
        if waiting:
            self.waiting.appendList(waiting)
        if first is not None:
            self._wake(first)
        return iter([])

    def _wake(self, at: int) -> None:
        self.handle.registerTimer((-(-at // 1000 // TICK_MS) + 1) * TICK_MS)

    def _keep(self, planned: dict[int, tuple]) -> None:
        for at, times in planned.items():
            held = self.versions.getValue((at,))
            self.versions.updateValue((at,), times if held is None else _larger(times, tuple(held)))
        planned.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        done = timerValues.getCurrentWatermarkInMs() * 1000
        versions = sorted((k[0], tuple(v)) for k, v in self.versions.iterator())
        since = [v[0] for v in versions]
        left, out = [], []
        for at, event_type, reported in sorted(map(tuple, self.waiting.get()), key=lambda r: r[0]):
            if at > done:
                left.append((at, event_type, reported))
                continue
            n = bisect_right(since, at)
            if n:
                out.append(Row(**dict(zip(MET_NAMES, (*key, at, event_type, reported, *versions[n - 1][1])))))
        self.waiting.clear()
        if left:
            self.waiting.put(left)
        passed = bisect_right(since, done)
        for at in since[: max(0, passed - 1)]:
            self.versions.removeKey((at,))
        ahead = [r[0] for r in left[:1]] + since[passed : passed + 1]
        if ahead:
            self._wake(min(ahead))
        yield from out

    def close(self) -> None:
        pass


def delay_stream(schedule: DataFrame, ts: DataFrame, delay: str = joins.WATERMARK) -> DataFrame:
    """:func:`delays.delay_as_of` of two streams: ``rid, tpl, event_time, delay``.

    State is keyed by journey and location, so a busy journey is spread by its locations.
    A row may come up to ``delay`` after later ones of either stream without changing the result.
    """
    nothing = F.lit(None).cast("string")
    plan = schedule.select("rid", "tpl", "event_time", F.lit(True).alias("plan"), "wta", "wtd", "wtp",
                           nothing.alias("event_type"), nothing.alias("reported_time"))
    status = delays.reported(ts).select("rid", "tpl", "event_time", F.lit(False).alias("plan"),
                                        *(nothing.alias(c) for c in ("wta", "wtd", "wtp")), "event_type", "reported_time")
    both = plan.unionByName(status).withWatermark("event_time", delay).filter("rid IS NOT NULL AND tpl IS NOT NULL AND event_time IS NOT NULL")
    # Time goes along as a number: a closing record's year is beyond what a Pandas timestamp holds.
    both = both.withColumn("at", F.unix_micros("event_time")).drop("event_time")
    met = both.groupBy("rid", "tpl").transformWithState(_AsOf(), MET, "Append", "EventTime")
    planned = F.struct("wta", "wtd", "wtp").alias("planned")
    return delays.measured(met.select("rid", "tpl", F.timestamp_micros("at").alias("event_time"), "event_type", "reported_time", planned))
