"""Whole jobs out of the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.functions.expressions import window_text, with_once
from feedlake.functions.payload import as_text, inflate
from feedlake.operators import delays, ingest, joins, keyed, sketches
from feedlake.operators.similar import THRESHOLD, settled, similar_pairs
from feedlake.operators.validate import validate_feed


def windowed(df: DataFrame, window: str) -> DataFrame:
    """Rows with ``window_end`` text of their tumbling window; rows without a journey go."""
    end = F.window("event_time", window)["end"]
    return df.filter("rid IS NOT NULL").withColumn("window_end", window_text(end)).drop("event_time")


def signatures(joined: DataFrame, window: str = "1 minute") -> DataFrame:
    """``rid, window_end, minhash_signature`` of joined rows with an ``event_time``."""
    return sketches.minhash_signature(windowed(joined, window), ["rid", "window_end"])


def bloom_filters(joined: DataFrame, window: str = "1 minute") -> DataFrame:
    """``rid, window_end, bloom_filter_base64`` of joined rows with an ``event_time``."""
    return sketches.bloom_filter(windowed(joined, window), ["rid", "window_end"])


def joined_features(schedule_records: DataFrame, ts_records: DataFrame, window: str) -> DataFrame:
    """Distinct joined features of two JSON record streams; event time is the join window's last moment."""
    schedule = keyed.parse_keyed_json(schedule_records, keyed.SCHEDULE_FIELDS)
    status = keyed.parse_keyed_json(ts_records, keyed.TS_FIELDS)
    features = joins.journey_features(schedule, status, window)
    return features.withColumn("event_time", F.col("win.end") - F.expr("INTERVAL 1 MILLISECOND")).drop("win")


def journey_similarity(
    schedule_records: DataFrame,
    ts_records: DataFrame,
    join_window: str = joins.JOIN_WINDOW,
    signature_window: str = "1 minute",
    threshold: float = THRESHOLD,
    scratch: str | None = None,
    search: Callable[..., DataFrame] = similar_pairs,
) -> DataFrame:
    """Records of both topics -> window join -> signatures -> similar pairs."""
    features = joined_features(schedule_records, ts_records, join_window)
    return search(signatures(features, signature_window), threshold, scratch=scratch)


def feed_outcomes(messages: DataFrame, ts_first: bool = True) -> tuple[DataFrame, DataFrame]:
    """Compressed messages -> (routed messages that are valid, the others with their ``reject_reason``).

    A message that doesn't inflate is rejected as ``payload``, one that isn't a feed document as ``document``.
    """
    raw = with_once(messages, "_raw", inflate(F.col("payload")))
    body = raw.withColumn("body", as_text(F.col("_raw"))).drop("_raw", "payload")
    doc = F.from_xml("body", schemas.FEED, {"ignoreNamespace": "true"})
    parsed = with_once(body, "doc", doc)
    readable = F.col("doc._ts").isNotNull() & F.col("doc._version").isNotNull()
    unread = parsed.filter(~F.coalesce(readable, F.lit(False)))
    reason = F.when(F.col("body").isNull(), "payload").otherwise("document")
    unread = unread.withColumn("reject_reason", reason).drop("body", "doc")
    checked = validate_feed(ingest.route_messages(parsed.filter(readable).drop("body"), ts_first))
    invalid = checked.filter("NOT valid").select(*unread.columns)
    return checked.filter("valid"), unread.unionByName(invalid)


def feed_to_rows(messages: DataFrame, ts_first: bool = True) -> tuple[DataFrame, DataFrame]:
    """Compressed messages -> (status rows, schedule rows) of the valid messages."""
    valid, _ = feed_outcomes(messages, ts_first)
    return ingest.flatten_ts(valid), ingest.flatten_schedule(valid)


def _bucketed(vectors: DataFrame, plane_count: int, seed: int) -> DataFrame:
    planes = delays.planes(plane_count, delays.VECTOR_LENGTH, seed)
    return vectors.withColumn("bucket", delays.lsh_bucket(F.col("delays"), planes))


def delay_patterns(
    schedule: DataFrame, ts: DataFrame, plane_count: int = 4, seed: int = 42
) -> DataFrame:
    """Delays -> per-journey vector -> bucket and its explanation."""
    bucketed = _bucketed(delays.delay_vector(delays.delay_calc(schedule, ts)), plane_count, seed)
    return bucketed.withColumn("explanation", delays.explain_bucket(F.col("bucket"), F.col("delays")))


def _with_bucket(rows: DataFrame, per_journey: list, scratch: str, plane_count: int, seed: int) -> DataFrame:
    """One row per journey: its bucket and sums of its delays, which are written once and read twice."""
    rows = settled(rows, scratch, "delays")
    buckets = _bucketed(delays.delay_vector(rows), plane_count, seed).select("rid", "bucket")
    return settled(rows.groupBy("rid").agg(*per_journey).join(buckets, "rid"), scratch, "journeys")


def pattern_moments(
    schedule: DataFrame, ts: DataFrame, scratch: str, plane_count: int = 4, seed: int = 42
) -> DataFrame:
    """Moments of all delays per bucket of the journey they belong to.

    What moves is one row per journey. Variance is that within the journeys plus that
    between them, so large means don't cancel it.
    """
    sums = [F.count("delay").alias("n"), F.avg("delay").alias("m"), F.var_pop("delay").alias("v")]
    journeys = _with_bucket(delays.delay_calc(schedule, ts), sums, scratch, plane_count, seed)
    weighted = F.sum(F.col("n") * F.col("m")) / F.sum("n")
    means = journeys.groupBy("bucket").agg(F.sum("n").alias("all"), weighted.alias("mean"))
    apart = F.col("m") - F.col("mean")
    spread = F.sum(F.col("n") * (F.col("v") + apart * apart)) / F.col("all")
    joined = journeys.join(means, "bucket").groupBy("bucket", "all", "mean").agg(spread.alias("variance"))
    return joined.select("bucket", F.col("all").alias("n"), "mean", "variance")


def pattern_sums(
    schedule: DataFrame,
    ts: DataFrame,
    scratch: str,
    bound: float = delays.DELAY_BOUND,
    plane_count: int = 4,
    seed: int = 42,
) -> DataFrame:
    """``bucket, n, total, squares`` of the clipped delays, for :func:`delays.dp_moments`."""
    clipped = F.greatest(F.lit(-bound), F.least(F.lit(bound), F.col("delay")))
    sums = [F.count("delay").alias("n"), F.sum(clipped).alias("t"), F.sum(clipped * clipped).alias("s")]
    journeys = _with_bucket(delays.delay_calc(schedule, ts), sums, scratch, plane_count, seed)
    return journeys.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.sum("t").alias("total"), F.sum("s").alias("squares")
    )
