"""The jobs as streams: the batch operators plus watermark, sink and checkpoint.

Every job takes its source as a streaming DataFrame, so it runs on topics and on
replayed files alike. ``time="event"`` takes the records' own time; ``"arrival"``
stamps them with the clock of the micro-batch that reads them. Spark closes an arrival-time window
when a later batch moves the watermark past it, not by the clock alone.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from feedlake.functions.expressions import window_text
from feedlake.operators import counts, joins, sketches
from feedlake.operators.similar import THRESHOLD

AGGREGATE_WINDOW = "1 minute"


def timed(df: DataFrame, delay: str = joins.WATERMARK, time: str = "event") -> DataFrame:
    """The stream with ``event_time`` set and watermarked."""
    if time == "arrival":
        df = df.withColumn("event_time", F.current_timestamp())
        delay = "0 seconds"
    elif time != "event":
        raise ValueError("time must be 'event' or 'arrival'")
    return df.withWatermark("event_time", delay)


def join_stream(
    schedule: DataFrame,
    ts: DataFrame,
    window: str = joins.JOIN_WINDOW,
    delay: str = joins.WATERMARK,
    slices: int = 1,
) -> DataFrame:
    """Windowed join of two watermarked streams; late rows are dropped, state goes with the window."""
    return joins.window_join(timed(schedule, delay), timed(ts, delay), window, slices=slices)


def _per_window(df: DataFrame, value: str) -> DataFrame:
    return df.select("rid", window_text(F.col("win.end")).alias("window_end"), value)


def minhash_stream(
    joined: DataFrame, window: str = AGGREGATE_WINDOW, delay: str = joins.WATERMARK, time: str = "event"
) -> DataFrame:
    """Signature per journey and window: constant state of one number per position."""
    rows = timed(joined, delay, time).filter("rid IS NOT NULL")
    keys = ["rid", F.window("event_time", window).alias("win")]
    return _per_window(sketches.minhash_running(rows, keys), "minhash_signature")


def bloom_stream(
    joined: DataFrame, window: str = AGGREGATE_WINDOW, delay: str = joins.WATERMARK, time: str = "event"
) -> DataFrame:
    """Filter of visited locations per journey and window."""
    rows = timed(joined, delay, time).filter("rid IS NOT NULL")
    keys = ["rid", F.window("event_time", window).alias("win")]
    return _per_window(sketches.bloom_filter(rows, keys), "bloom_filter_base64")


def count_stream(
    joined: DataFrame,
    window: str = AGGREGATE_WINDOW,
    delay: str = joins.WATERMARK,
    time: str = "event",
    event_types: Sequence[str] = counts.VISIT_EVENTS,
) -> DataFrame:
    """Exact distinct journeys per location and window, before noise."""
    return counts.distinct_count_window(timed(joined, delay, time), window, event_types)


def dp_count_stream(joined: DataFrame, secret: str, **settings) -> DataFrame:
    """The private release of :func:`count_stream`; the secret makes a retried batch publish the same values."""
    return counts.dp_noisy_count(count_stream(joined, **settings), secret)


def similarity_stream(
    signatures: DataFrame, threshold: float = THRESHOLD, delay: str = "1 minute", slices: int = 1
) -> DataFrame:
    """Pairs of one window out of a signature stream, given out once the window is closed.

    Journeys meet on the (position, value) tokens they share and the meetings of a
    pair are counted, so journeys with nothing in common are never compared.
    ``window_end`` is read back as a timestamp and watermarked; tokens and counts
    leave the state with their window. ``slices`` cuts every token's meeting into a
    grid of that many parts per side, for feeds with very common features.
    """
    values = F.col("minhash_signature")
    tokens = F.filter(F.transform(values, lambda v, i: F.struct(i.alias("i"), v.alias("v"))), lambda t: t["v"].isNotNull())
    rows = signatures.select(
        F.to_timestamp("window_end", "yyyy-MM-dd HH:mm:ss.SSS").alias("ends_at"),
        "rid",
        F.size(values).alias("n"),
        F.inline(tokens),
    )
    keys = ["ends_at", "n", "i", "v", "x", "y"]
    own = F.pmod(F.xxhash64("rid"), F.lit(slices)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))

    def side(name: str, x: Column, y: Column) -> DataFrame:
        cut = rows.withColumn("x", x).withColumn("y", y).withColumnRenamed("rid", name)
        return cut.withWatermark("ends_at", delay)

    met = side("rid1", own, every).join(side("rid2", every, own), keys).filter("rid1 < rid2")
    overlap = met.groupBy("ends_at", "rid1", "rid2", "n").agg(F.count("*").alias("met"))
    similarity = F.col("met") / F.col("n")
    return overlap.filter(similarity >= threshold).select(
        window_text(F.col("ends_at")).alias("window_end"), "rid1", "rid2", similarity.alias("similarity")
    )


def _ending(signatures: DataFrame, delay: str) -> DataFrame:
    ends_at = F.to_timestamp("window_end", "yyyy-MM-dd HH:mm:ss.SSS").alias("ends_at")
    rows = signatures.filter("rid IS NOT NULL").select(ends_at, "rid", "minhash_signature")
    return rows.withWatermark("ends_at", delay)


def class_names(signatures: DataFrame, delay: str = "1 minute") -> DataFrame:
    """Of the journeys of a window with equal signatures the least ``rid``, once the window is closed."""
    named = _ending(signatures, delay).groupBy("ends_at", "minhash_signature").agg(F.min("rid").alias("rid"))
    return named.select("rid", window_text(F.col("ends_at")).alias("window_end"), "minhash_signature")


def class_copies(signatures: DataFrame, threshold: float = THRESHOLD, delay: str = "1 minute") -> DataFrame:
    """Every other journey of a class with the class's name, as a pair; the state holds ids and no signatures."""
    values = F.col("minhash_signature")
    n = F.size(values)
    # with their positions, as the hash of an array passes over its NULLs
    tokens = F.filter(F.transform(values, lambda v, i: v * n + i), lambda t: t.isNotNull())
    ids = [F.xxhash64(n, tokens).alias("id1"), F.xxhash64(F.lit("second"), tokens, n).alias("id2")]
    share = F.size(tokens) / n
    rows = _ending(signatures, delay).select("ends_at", *ids, share.alias("similarity"), F.col("rid").alias("rid2"))
    rows = rows.filter(F.col("similarity") >= threshold)
    names = rows.groupBy("ends_at", "id1", "id2", "similarity").agg(F.min("rid2").alias("rid1"))
    copies = rows.drop("similarity").join(names, ["ends_at", "id1", "id2"]).filter("rid1 <> rid2")
    return copies.select(window_text(F.col("ends_at")).alias("window_end"), "rid1", "rid2", "similarity")


def to_folder(
    df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", trigger: Mapping | None = None
) -> StreamingQuery:
    """Append a stream to a folder; the default trigger drains what is there and stops."""
    writer = df.writeStream.format(fmt).outputMode("append")
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def drain(df: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream over everything available, into a Parquet folder, and wait for it."""
    to_folder(df, path, checkpoint).awaitTermination()
