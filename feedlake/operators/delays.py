"""Delays per journey, delay vectors, projection buckets and their private moments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.functions.hashing import coefficients
from feedlake.functions.noise import add_laplace_noise, keyed_uniform

VECTOR_LENGTH = 5
HALF_DAY, DAY = 720.0, 1440.0
# Delays are clipped to this many minutes either way before a private release.
DELAY_BOUND = 120.0


def clock_minutes(text: Column) -> Column:
    """Minutes since midnight of ``HH:MM`` or ``HH:MM:SS``."""
    part = F.split(text, ":")
    seconds = F.coalesce(F.get(part, F.lit(2)).try_cast("double"), F.lit(0.0))
    hours, minutes = F.get(part, F.lit(0)).try_cast("double"), F.get(part, F.lit(1)).try_cast("double")
    return hours * 60 + minutes + seconds / 60


def clock_difference(later: Column, earlier: Column) -> Column:
    """Minutes from ``earlier`` to ``later``; beyond half a day the next or previous day is meant."""
    gap = clock_minutes(later) - clock_minutes(earlier)
    return F.when(gap > HALF_DAY, gap - DAY).when(gap < -HALF_DAY, gap + DAY).otherwise(gap)


def latest_plan(schedule: DataFrame) -> DataFrame:
    """``rid, tpl, planned``: the working times of the latest schedule row per (journey, location)."""
    times = F.struct("wta", "wtd", "wtp")
    latest = F.max_by(times, F.struct("event_time", times))
    return schedule.groupBy("rid", "tpl").agg(latest.alias("planned"))


def reported(ts: DataFrame) -> DataFrame:
    """Status rows with a time: the actual one, else the forecast."""
    forecast = F.col("forecast_time") if "forecast_time" in ts.columns else F.lit(None).cast("string")
    reported = F.coalesce("actual_time", forecast).alias("reported_time")
    return ts.select("rid", "tpl", "event_time", "event_type", reported).filter("reported_time IS NOT NULL")


def measured(met: DataFrame) -> DataFrame:
    """Delay of reported rows that met their plan."""
    planned = (
        F.when(F.col("event_type") == "arr", F.col("planned.wta"))
        .when(F.col("event_type") == "dep", F.col("planned.wtd"))
        .when(F.col("event_type") == "pass", F.col("planned.wtp"))
    )
    any_time = F.coalesce("planned.wta", "planned.wtd", "planned.wtp")
    delay = clock_difference(F.col("reported_time"), F.coalesce(planned, any_time))
    rows = met.select("rid", "tpl", "event_time", delay.alias("delay"))
    return rows.filter(F.col("delay").isNotNull())


def delay_calc(schedule: DataFrame, ts: DataFrame) -> DataFrame:
    """``rid, tpl, event_time, delay`` (minutes) for every status row with a scheduled time.

    The delay is that of the actual time, or of the forecast where there is none yet.
    The schedule is first reduced to its latest row per (journey, location), so each
    status row meets at most one: a location repeated in both streams cannot
    multiply, and the reduction combines on the map side. Each side is read once;
    adaptive execution splits the status rows of a very busy (journey, location).
    """
    return measured(reported(ts).join(latest_plan(schedule), ["rid", "tpl"]))


def delay_as_of(schedule: DataFrame, ts: DataFrame, chunk: str = "1 day") -> DataFrame:
    """:func:`delay_calc` with the plan in force when the status row was sent, not the table's latest one.

    In force is the last schedule row of the journey and location up to the status row's
    own time. The rows of a pair are cut by time into chunks that are ordered apart; a
    chunk takes one row from those before it, the last plan, so no task orders a hot pair
    as a whole.
    """
    times = F.struct("wta", "wtd", "wtp")
    plans = schedule.filter("rid IS NOT NULL AND tpl IS NOT NULL AND event_time IS NOT NULL")
    plans = plans.groupBy("rid", "tpl", "event_time").agg(F.max(times).alias("planned"))
    rows = plans.withColumn("event_type", F.lit(None).cast("string")).withColumn("reported_time", F.lit(None).cast("string"))
    status = reported(ts).filter("rid IS NOT NULL AND tpl IS NOT NULL AND event_time IS NOT NULL")
    both = rows.unionByName(status.withColumn("planned", F.lit(None).cast(plans.schema["planned"].dataType)))
    both = both.withColumn("chunk", F.window("event_time", chunk)["start"])
    pair = ["rid", "tpl"]
    last = F.max_by("planned", F.when(F.col("planned").isNotNull(), F.col("event_time")))
    ends = both.groupBy(*pair, "chunk").agg(last.alias("last"))
    before = Window.partitionBy(*pair).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*pair, "chunk", F.last("last", ignorenulls=True).over(before).alias("carried"))
    both = both.join(carried, [*pair, "chunk"])
    # A schedule row of the same moment is in force already.
    since = Window.partitionBy(*pair, "chunk").orderBy("event_time", F.col("planned").isNull())
    in_force = F.coalesce(F.last("planned", ignorenulls=True).over(since.rowsBetween(Window.unboundedPreceding, 0)), "carried")
    met = both.withColumn("planned", F.struct(in_force.alias("p"), F.col("planned").isNull().alias("status")))
    met = met.filter("planned.status AND planned.p IS NOT NULL")
    return measured(met.withColumn("planned", F.col("planned.p")))


def delays_against(plan: DataFrame, ts: DataFrame) -> DataFrame:
    """:func:`delay_calc` for a status stream against a table made by :func:`latest_plan`."""
    return measured(reported(ts).join(plan, ["rid", "tpl"]))


def delay_vector(delays: DataFrame, length: int = VECTOR_LENGTH) -> DataFrame:
    """Each journey's last ``length`` delays, oldest first.

    The rank limit is applied before the shuffle as well, so of a hot journey each
    map task passes on only its own last ``length`` rows.
    """
    newest = Window.partitionBy("rid").orderBy(
        F.desc("event_time"), F.desc("tpl"), F.desc("delay")
    )
    last = delays.withColumn("rank", F.row_number().over(newest)).filter(F.col("rank") <= length)
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("rank")).alias("at"), "delay")))
    return last.groupBy("rid").agg(
        F.transform(ordered, lambda x: x["delay"]).alias("delays"),
        F.max("event_time").alias("event_time"),
    )


def running_delay_vector(
    delays: DataFrame, length: int = VECTOR_LENGTH, chunk: str = "1 hour"
) -> DataFrame:
    """For every delay, the vector of it and up to ``length - 1`` delays before it.

    A journey's rows are cut by time into chunks handled apart. What a chunk needs
    from the past is at most ``length - 1`` rows, taken from the last rows of the
    chunks before it, so no task sorts a hot journey as a whole.
    """
    order = ["event_time", "tpl", "delay"]
    rows = delays.withColumn("chunk", F.window("event_time", chunk)["start"])
    newest = Window.partitionBy("rid", "chunk").orderBy(*[F.desc(c) for c in order])
    tail = (
        rows.withColumn("rank", F.row_number().over(newest))
        .filter(F.col("rank") < length)
        .groupBy("rid", "chunk")
        .agg(F.array_sort(F.collect_list(F.struct(*order))).alias("tail"))
    )
    # every earlier chunk holds at least one row, so length-1 of them are enough
    before = Window.partitionBy("rid").orderBy("chunk").rowsBetween(-(length - 1), -1)
    past = tail.withColumn("past", F.flatten(F.collect_list("tail").over(before)))
    carried = past.select("rid", "chunk", F.explode(_last(F.col("past"), length - 1)).alias("c"))
    old = carried.select("rid", "chunk", *[F.col(f"c.{o}").alias(o) for o in order], F.lit(False).alias("own"))
    both = rows.select("rid", "chunk", *order, F.lit(True).alias("own")).unionByName(old)
    frame = Window.partitionBy("rid", "chunk").orderBy("own", *order).rowsBetween(-(length - 1), 0)
    vectors = both.withColumn("delays", F.collect_list("delay").over(frame))
    return vectors.filter("own").select("rid", "tpl", "event_time", "delay", "delays")


def _last(items: Column, count: int) -> Column:
    start = F.greatest(F.size(items) - count + 1, F.lit(1))
    return F.slice(items, start, count)


def planes(count: int, dimensions: int, seed: int = 42) -> list[list[float]]:
    """``count`` seeded random planes with components in [-1, 1), six decimals."""
    pairs = coefficients(count * dimensions, seed)
    flat = [round(b / 2**30 - 1, 6) for _, b in pairs]
    return [flat[i * dimensions : (i + 1) * dimensions] for i in range(count)]


def lsh_bucket(vector: Column, normals: Sequence[Sequence[float]]) -> Column:
    """Bucket id: for each plane 1 if the vector lies on or above it, else 0.

    Missing components, at the end or NULL, count as zero; components beyond the
    planes' width don't count. Any width takes the same path.
    """

    def side(normal: Sequence[float]) -> Column:
        weights = F.array(*[F.lit(float(c)) for c in normal])
        nothing = F.lit(0.0)
        products = F.zip_with(vector, weights, lambda v, c: F.coalesce(v.cast("double"), nothing) * F.coalesce(c, nothing))
        return F.when(F.aggregate(products, nothing, lambda total, p: total + p) >= 0, "1").otherwise("0")

    return F.when(vector.isNotNull(), F.concat(*[side(n) for n in normals]))


def dp_moments(
    sums: DataFrame,
    secret: str | None = None,
    bound: float = DELAY_BOUND,
    epsilon: float = 1.0,
    rows: int = 1,
    release: str | None = None,
) -> DataFrame:
    """``bucket, noisy_n, noisy_mean, noisy_variance`` from ``bucket, n, total, squares`` of clipped delays.

    For one person's ``rows`` delays, all in one bucket, the count changes by ``rows``, the
    sum by at most ``rows * bound`` and the sum of squares by at most ``rows * bound ** 2``.
    Each of the three gets Laplace noise for a third of ``epsilon``; mean and variance are
    computed from the noisy sums alone and held within what clipped delays can give. With
    the default of one row this protects a single delay that leaves its journey's bucket
    as it is, no more; ``privacy.release_moments`` protects whole journeys.
    """
    named = [F.lit(release)] if release is not None else []

    def noisy(column: str, sensitivity: float) -> Column:
        uniform = keyed_uniform(secret, F.col("bucket"), F.lit(column), *named) if secret else None
        return add_laplace_noise(F.col(column), sensitivity, epsilon / 3, uniform).alias(column)

    limits = {"n": float(rows), "total": rows * bound, "squares": rows * bound * bound}
    drawn = sums.select("bucket", *[noisy(c, s) for c, s in limits.items()])
    count = F.greatest(F.col("n"), F.lit(1.0))
    mean = F.greatest(F.lit(-bound), F.least(F.lit(bound), F.col("total") / count))
    variance = F.greatest(F.lit(0.0), F.least(F.lit(bound * bound), F.col("squares") / count - mean * mean))
    return drawn.select(
        "bucket", F.col("n").alias("noisy_n"), mean.alias("noisy_mean"), variance.alias("noisy_variance")
    )


def explain_bucket(bucket: Column, vector: Column) -> Column:
    """One sentence on why a vector looks the way it does: how it starts and where it goes."""
    first, last = F.get(vector, F.lit(0)), F.element_at(vector, -1)
    start = (
        F.when(first <= 0, "no initial delay")
        .when(first < 5, "low initial delay")
        .otherwise("high initial delay")
    )
    trend = (
        F.when(last - first < -1, "recovering").when(last - first > 1, "worsening").otherwise("steady")
    )
    return F.when(
        F.size(vector) > 0, F.concat(F.lit("Bucket "), bucket, F.lit(": "), start, F.lit(", "), trend)
    )
