"""Moments of delays per bucket as a stream: journeys come, grow, and move from bucket to bucket."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from feedlake.operators import delays

CHANGES = "bucket string, part int, n bigint, mean double, apart double"
STATES = "bucket string, part int, version bigint, n bigint, mean double, apart double"

Moments = tuple[int, float, float]  # count, mean, sum of squared deviations from the mean
NOTHING: Moments = (0, 0.0, 0.0)


def of(values: np.ndarray) -> Moments:
    mean = float(values.mean())
    return len(values), mean, float(((values - mean) ** 2).sum())


def together(groups: Sequence[Moments]) -> Moments:
    """Moments of several groups as one; deviations are taken from the common mean, so large means cancel nothing."""
    n, means, apart = (np.array(x, dtype=np.float64) for x in zip(*groups)) if groups else (np.zeros(0),) * 3
    total = n.sum()
    if not total:
        return NOTHING
    mean = means[0] + float((n * (means - means[0])).sum() / total)
    return int(total), mean, float(apart.sum() + (n * (means - mean) ** 2).sum())


def without(whole: Moments, gone: Moments) -> Moments:
    """Moments of what is left once a group that was part of the whole is taken out."""
    n = whole[0] - gone[0]
    if n <= 0:
        return NOTHING
    gap = gone[1] - whole[1]
    return n, whole[1] - gap * gone[0] / n, max(0.0, whole[2] - gone[2] - gap * gap * gone[0] * whole[0] / n)


class _Journey(StatefulProcessor):
    """A journey's moments and its last delays; gives out what it takes from its old bucket and brings to its new one."""

    def __init__(self, planes: list[list[float]], length: int, parts: int):
        self.planes, self.length, self.parts = planes, length, parts

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = "at array<bigint>, tpl array<string>, delay array<double>, n bigint, mean double, apart double, bucket string, part int"
        self.kept = handle.getValueState("kept", fields)

    def _bucket(self, vector: list[float]) -> str:
        sides = []
        for plane in self.planes:
            total = 0.0
            for i, weight in enumerate(plane):
                total += (vector[i] if i < len(vector) else 0.0) * weight
            sides.append("1" if total >= 0 else "0")
        return "".join(sides)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        old = self.kept.get() if self.kept.exists() else None
        last = list(zip(*old[:3])) if old else []
        own: Moments = tuple(old[3:6]) if old else NOTHING
        part = None
        for batch in rows:
            own = together([own, of(batch["delay"].to_numpy(dtype=np.float64))])
            newer = batch[["at", "tpl", "delay"]].sort_values(["at", "tpl", "delay"]).tail(self.length)
            last = sorted([*last, *((int(a), t, float(d)) for a, t, d in newer.itertuples(index=False))])[-self.length :]
            part = int(batch["part"].iloc[0])
        bucket = self._bucket([d for _, _, d in last])
        at, tpl, delay = map(list, zip(*last))
        self.kept.update((at, tpl, delay, *own, bucket, part))
        changes = [(bucket, part, *own)]
        if old:
            changes.append((old[6], old[7], -old[3], old[4], old[5]))
        yield pd.DataFrame(changes, columns=["bucket", "part", "n", "mean", "apart"])

    def close(self) -> None:
        pass


class _Bucket(StatefulProcessor):
    """A bucket's moments; journeys that leave are taken out of them."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "version bigint, n bigint, mean double, apart double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        version, *own = self.kept.get() if self.kept.exists() else (0, *NOTHING)
        own, gone = tuple(own), NOTHING
        for batch in rows:
            found = list(batch[["n", "mean", "apart"]].itertuples(index=False, name=None))
            own = together([own, *(m for m in found if m[0] > 0)])
            gone = together([gone, *((-n, m, a) for n, m, a in found if n < 0)])
        own = without(own, gone) if gone[0] else own
        self.kept.update((version + 1, *own))
        yield pd.DataFrame([(*key, version + 1, *own)], columns=[x.split()[0] for x in STATES.split(", ")])

    def close(self) -> None:
        pass


def moment_changes(late: DataFrame, plane_count: int = 4, seed: int = 42, parts: int = 8) -> DataFrame:
    """:data:`STATES` of a stream of delays ``rid, event_time, tpl, delay``: a bucket's moments whenever they change.

    A journey counts with all its delays in the bucket of its last ones, and moves with
    all of them. Its state is a few numbers. ``parts`` spreads a bucket by journey.
    """
    part = F.pmod(F.xxhash64("rid"), F.lit(parts)).cast("int").alias("part")
    rows = late.select("rid", F.unix_micros("event_time").alias("at"), "tpl", "delay", part)
    planes = delays.planes(plane_count, delays.VECTOR_LENGTH, seed)
    changes = rows.groupBy("rid").transformWithStateInPandas(
        _Journey(planes, delays.VECTOR_LENGTH, parts), CHANGES, "Append", "None"
    )
    return changes.groupBy("bucket", "part").transformWithStateInPandas(_Bucket(), STATES, "Append", "None")


def latest_moments(states: DataFrame) -> DataFrame:
    """``bucket, n, mean, variance`` by the newest state of each part of each bucket."""
    newest = states.groupBy("bucket", "part").agg(F.max_by(F.struct("n", "mean", "apart"), "version").alias("s"))
    every = Window.partitionBy("bucket")
    rows = newest.select("bucket", "s.*").where("n > 0").withColumn("all", F.sum("n").over(every))
    rows = rows.withColumn("common", F.sum(F.col("n") * F.col("mean")).over(every) / F.col("all"))
    spread = F.sum(F.col("apart") + F.col("n") * (F.col("mean") - F.col("common")) ** 2) / F.first("all")
    return rows.groupBy("bucket").agg(F.first("all").alias("n"), F.first("common").alias("mean"), spread.alias("variance"))
