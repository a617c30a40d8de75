"""Private moments per journey: bounded contributions, and a ledger of what has been spent."""

from __future__ import annotations

from itertools import product

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.operators import delays

ENTRIES = "release string, epsilon double, digest bigint"


class BudgetSpent(Exception):
    """A release would cost more than is left."""


class Ledger:
    """Releases paid for so far, as a table in a shared folder that all jobs on the same data use.

    What was published once costs nothing when it is published again unchanged, as a
    retried job does. The same release over other data is refused, since the same noise
    would give away what changed. Jobs that share a ledger charge it one after the other.
    """

    def __init__(self, spark: SparkSession, path: str, budget: float):
        self.spark, self.path, self.budget = spark, path, budget

    def entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(ENTRIES).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], ENTRIES)

    def spent(self) -> float:
        each = self.entries().groupBy("release").agg(F.max("epsilon").alias("epsilon"))
        return each.agg(F.coalesce(F.sum("epsilon"), F.lit(0.0))).first()[0]

    def charge(self, release: str, epsilon: float, digest: int) -> None:
        known = self.entries().where(F.col("release") == release).select("digest").distinct().limit(2).collect()
        if known:
            if [r.digest for r in known] != [digest]:
                raise ValueError(f"release {release!r} was published over other data")
            return
        if self.spent() + epsilon > self.budget * (1 + 1e-12):
            raise BudgetSpent(f"{release!r} costs {epsilon}, of {self.budget} there is {self.budget - self.spent():.6g} left")
        entry = self.spark.createDataFrame([(release, float(epsilon), digest)], ENTRIES)
        entry.coalesce(1).write.mode("append").parquet(self.path)


def journey_sums(
    late: DataFrame, rows: int = delays.VECTOR_LENGTH, bound: float = delays.DELAY_BOUND, plane_count: int = 4, seed: int = 42
) -> DataFrame:
    """``bucket, n, total, squares`` of the last ``rows`` delays of each journey, clipped, for every bucket there can be.

    A journey counts in one bucket only, so adding or removing one changes one row: the
    count by at most ``rows``, the sum by ``rows * bound``, the squares by ``rows * bound ** 2``.
    Buckets without a journey are there too, as their absence would tell.
    """
    last = delays.delay_vector(late, max(rows, delays.VECTOR_LENGTH))
    recent = F.slice("delays", F.greatest(F.size("delays") - (delays.VECTOR_LENGTH - 1), F.lit(1)), delays.VECTOR_LENGTH)
    bucket = delays.lsh_bucket(recent, delays.planes(plane_count, delays.VECTOR_LENGTH, seed)).alias("bucket")
    own = F.slice("delays", F.greatest(F.size("delays") - (rows - 1), F.lit(1)), rows)
    clipped = F.transform(own, lambda d: F.greatest(F.lit(-bound), F.least(F.lit(bound), d)))
    def total(values):
        return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)

    each = last.select(bucket, clipped.alias("c")).select(
        "bucket", F.size("c").alias("n"), total(F.col("c")).alias("t"), total(F.transform("c", lambda x: x * x)).alias("s")
    )
    sums = each.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("t").alias("total"), F.sum("s").alias("squares"))
    names = ["".join(x) for x in product("01", repeat=plane_count)]
    every = late.sparkSession.createDataFrame([(n,) for n in names], "bucket string")
    filled = [F.coalesce(c, F.lit(0)).cast(t).alias(c) for c, t in (("n", "bigint"), ("total", "double"), ("squares", "double"))]
    return every.join(sums, "bucket", "left").select("bucket", *filled)


def release_moments(
    sums: DataFrame,
    ledger: Ledger,
    release: str,
    secret: str,
    rows: int = delays.VECTOR_LENGTH,
    bound: float = delays.DELAY_BOUND,
    epsilon: float = 1.0,
) -> DataFrame:
    """``bucket, noisy_n, noisy_mean, noisy_variance``: private for whole journeys, and paid for.

    ``sums`` is a settled :func:`journey_sums`; ``epsilon`` covers all three statistics of
    all buckets, as a journey is in one of them. The noise follows from the secret and the
    name of the release, so two releases never share it.
    """
    digest = sums.agg(F.bit_xor(F.xxhash64("bucket", "n", "total", "squares")).alias("d")).first().d
    ledger.charge(release, epsilon, digest)
    return delays.dp_moments(sums, secret, bound, epsilon, rows, release)
