"""Schedule rows meet status rows of the same journey inside one event-time window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Window and lateness of the join, and the names of the joined fields.
JOIN_WINDOW = "30 seconds"
WATERMARK = "5 seconds"

_SCHEDULE = {"uid": "uid", "tpl": "sch_tpl", "wta": "sch_wta", "wtd": "sch_wtd", "wtp": "sch_wtp"}
_STATUS = {
    "tpl": "ts_tpl", "pta": "ts_pta", "ptd": "ts_ptd", "wta": "ts_wta", "wtd": "ts_wtd",
    "wtp": "ts_wtp", "event_type": "event_type", "actual_time": "actual_time",
}


def _side(df: DataFrame, names: dict[str, str], window: str, null_text: str | None) -> DataFrame:
    """Window, key and renamed fields; the raw timestamp goes, so that a streaming join has one event time."""

    def field(source: str, target: str) -> Column:
        text = F.col(source).cast("string")
        return (text if null_text is None else F.coalesce(text, F.lit(null_text))).alias(target)

    return df.select(
        F.window("event_time", window).alias("win"), "rid", *[field(s, t) for s, t in names.items()]
    )


def window_join(
    schedule: DataFrame,
    ts: DataFrame,
    window: str = JOIN_WINDOW,
    null_text: str | None = "null",
    slices: int = 1,
) -> DataFrame:
    """Every schedule row with every status row of the journey in the same tumbling window.

    Both sides need ``rid``, ``event_time`` and their fields. Missing fields read
    as ``null_text`` (a text by default, ``None`` keeps them NULL). On streams, set
    the watermarks first. One shuffle per side, on (window, journey). In batch,
    adaptive execution splits a window-journey that outgrows its partition. Streams
    have no such step: ``slices`` spreads the status rows of every window-journey
    over that many tasks and gives each a copy of its schedule rows.
    """
    left = _side(schedule, _SCHEDULE, window, null_text)
    right = _side(ts, _STATUS, window, null_text)
    if slices == 1:
        return left.join(right, ["win", "rid"])
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    somewhere = F.pmod(F.xxhash64(*_STATUS.values()), F.lit(slices)).cast("int")
    left, right = left.withColumn("slice", everywhere), right.withColumn("slice", somewhere)
    return left.join(right, ["win", "rid", "slice"]).drop("slice")


def journey_features(
    schedule: DataFrame, ts: DataFrame, window: str = JOIN_WINDOW, null_text: str | None = "null"
) -> DataFrame:
    """Distinct (window, journey, scheduled, reported, event) combinations of :func:`window_join`.

    Sketches and distinct counts only depend on these. Each side is reduced to its
    distinct locations before the join, so repeated messages of a busy journey
    never multiply with each other.
    """
    left = _side(schedule, {"tpl": "sch_tpl"}, window, null_text).distinct()
    right = _side(ts, {"tpl": "ts_tpl", "event_type": "event_type"}, window, null_text).distinct()
    return left.join(right, ["win", "rid"])


def joined_record(joined: DataFrame) -> DataFrame:
    """Joined rows as JSON text, values escaped."""
    names = ["rid", *_SCHEDULE.values(), *_STATUS.values()]
    return joined.select(F.to_json(F.struct(*names)).alias("value"))
