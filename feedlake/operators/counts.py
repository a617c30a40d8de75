"""Distinct journeys per location and window, and their private release."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.functions.expressions import window_text
from feedlake.functions.noise import add_laplace_noise, keyed_uniform

# Event types that count as a visit, privacy parameters.
VISIT_EVENTS = ("pass", "arr", "dep")
SENSITIVITY, EPSILON = 1.0, 1.0


def relevant(df: DataFrame, event_types: Sequence[str] = VISIT_EVENTS) -> DataFrame:
    """Rows with a journey id and one of the event types."""
    return df.filter(F.col("rid").isNotNull() & F.col("event_type").isin(*event_types))


def distinct_count_window(
    df: DataFrame,
    window: str = "1 minute",
    event_types: Sequence[str] = VISIT_EVENTS,
    location: str = "ts_tpl",
) -> DataFrame:
    """``window_end, location, n_rids`` per tumbling window; a NULL location is a group too.

    Two levels: the first is keyed by the journey as well, so a busy location is
    spread by journey and reaches the second level as one row per journey with
    map-side counting. Both levels also run on a stream in append mode.
    """
    visits = relevant(df, event_types).groupBy(
        F.window("event_time", window).alias("win"), F.col(location).alias("location"), "rid"
    ).agg(F.lit(1).alias("seen"))
    return (
        visits.groupBy("win", "location")
        .agg(F.count("*").alias("n_rids"))
        .select(window_text(F.col("win.end")).alias("window_end"), "location", "n_rids")
    )


def dp_noisy_count(
    counts: DataFrame,
    secret: str | None = None,
    sensitivity: float = SENSITIVITY,
    epsilon: float = EPSILON,
) -> DataFrame:
    """``window_end, location, noisy_count`` from exact counts.

    With a ``secret`` the noise is a fixed function of it and the row's key; without
    one each evaluation draws anew.
    """
    uniform = keyed_uniform(secret, F.col("window_end"), F.col("location")) if secret else None
    noisy = add_laplace_noise(F.col("n_rids"), sensitivity, epsilon, uniform)
    return counts.select("window_end", "location", noisy.alias("noisy_count"))
