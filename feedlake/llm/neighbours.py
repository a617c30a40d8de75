"""Approximate nearest neighbours by inner product along shifted space-filling curves.

Vectors get one more component that makes all equally long, so that the largest inner
product is the nearest point. ``CURVES`` random projections to ``AXES`` dimensions,
each shifted by its own random amount, are ordered along a Hilbert curve and dealt by
key range into blocks, each about as large. A query takes the curves in whose
projection it stands out most, and is compared with the blocks within ``WINDOW`` of all
rows around its own key; the windows' best are merged and ranked by the exact product.

The window is a share of the rows, so recall doesn't fall as tables grow: on vectors
without any structure nothing narrower finds nine of ten neighbours. Blocks and the
slices of queries that meet them are bounded, whatever the table's size. Equal vectors
are one point; only as many of their ids as a query can return are kept with it.

Rows whose id or vector is null, or whose vector is empty, zero or holds null, NaN or
infinite components take no part. Missing components of a shorter vector count as zero.
A repeated id counts once per different vector. Ties go to the smaller id. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.store import settle

CURVES, AXES, BITS = 16, 3, 6
USED = 6
WINDOW = 0.25
#: Blocks per curve, if they then hold LEAST_ROWS each; rows per block and queries per slice at most (about).
BLOCKS, LEAST_ROWS, BLOCK_ROWS, SLICE_QUERIES = 20, 64, 8192, 2048
#: Vectors that centre, scale and block boundaries are fitted on, at most.
SAMPLE = 20_000


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of each row of non-negative integer coordinates below ``2 ** bits``.

    Coordinates are turned, from the coarsest bit down, into the frame of the
    sub-cube that the curve is in, and their bits interleaved in Gray code order.
    """
    x = cells.astype(np.int64).T.copy()
    for level in range(bits - 1, 0, -1):
        lower = (1 << level) - 1
        for axis in x:
            inside = (axis >> level & 1).astype(bool)
            swap = np.where(inside, 0, (x[0] ^ axis) & lower)
            x[0] ^= np.where(inside, lower, swap)
            axis ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turned = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        turned ^= np.where(x[-1] >> level & 1, (1 << level) - 1, 0)
    x ^= turned
    key = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in x:
            key = key << 1 | axis >> level & 1
    return key


class Curves:
    """Projections, grid and block boundaries; ``keys`` puts points on every curve."""

    def __init__(self, size: int, longest: float, seed: int = 17):
        random = np.random.default_rng(seed)
        self.size, self.longest = size, longest
        axes = [np.linalg.qr(random.normal(size=(size + 1, min(AXES, size + 1))))[0] for _ in range(CURVES)]
        self.axes = np.concatenate(axes, axis=1)
        self.shift = random.uniform(-0.05, 0.05, self.axes.shape[1])
        self.centre, self.spread = np.zeros(len(self.shift)), np.ones(len(self.shift))
        self.bounds: list[np.ndarray] = []

    def _project(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
        if query:
            vectors, last = vectors * (self.longest / lengths), np.zeros_like(lengths)
        else:
            last = np.sqrt(np.maximum(0, self.longest**2 - lengths**2))
        return np.hstack([vectors, last]) @ self.axes

    def keys(self, vectors: np.ndarray, query: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Per row and curve the key, and how far the row stands out from the centre."""
        scaled = (self._project(vectors, query) - self.centre) / self.spread
        cells = np.floor((scaled / 6 + 0.5 + self.shift) * (1 << BITS)).clip(0, (1 << BITS) - 1)
        each = cells.shape[1] // CURVES
        keys = [hilbert(cells[:, c * each : (c + 1) * each]) for c in range(CURVES)]
        # Low digits from the vector itself spread the rows of one cell over the boundaries.
        digits = np.modf(np.abs(vectors) @ np.linspace(1e3, 2e3, vectors.shape[1]))[0] * (1 << 20)
        out = np.stack([(k << 20) + digits.astype(np.int64) for k in keys], axis=1)
        return out, (scaled**2).reshape(len(vectors), CURVES, each).sum(axis=2)

    def fit(self, sample: np.ndarray, blocks: int) -> None:
        projected = self._project(sample, False)
        self.centre, self.spread = projected.mean(axis=0), projected.std(axis=0) + 1e-12
        cuts = np.linspace(0, 1, blocks + 1)[1:-1]
        self.bounds = [np.quantile(k, cuts) for k in self.keys(sample)[0].T]

    def blocks(self, keys: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(b, k, side="right") for b, k in zip(self.bounds, keys.T)], axis=1)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Lists of numbers as rows, shorter ones filled with zeros."""
    lengths = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy().astype(np.float64)
    if len(flat) == len(lengths) * size:
        return flat.reshape(-1, size)
    out = np.zeros((len(lengths), size))
    out[np.arange(size) < lengths[:, None]] = flat
    return out


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


PLACED = "curve int, block int, slice int, point bigint, vector array<double>"
FOUND = "point bigint, other bigint, score double"


def nearest(
    rows: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row whose id is divisible by ``every``."""
    spark = rows.sparkSession
    own = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    own = own.where(F.col("id").isNotNull() & usable(F.col("vector")))
    # Numbered in the order of their smallest ids, so that ties between points are ties between ids.
    points = own.groupBy("vector").agg(F.min("id").alias("first")).orderBy("first", "vector")
    points = settle(points.select(F.monotonically_increasing_id().alias("point"), "vector"), "points")
    members = settle(own.join(points, "vector").select("id", "point").distinct(), "members")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    n, size, longest = points.agg(F.count("*"), F.max(F.size("vector")), F.max(length)).first()
    if not n:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")

    curves = Curves(size, longest)
    sample = points.orderBy(F.xxhash64("point")).limit(SAMPLE).select("vector").toArrow()
    blocks = max(1, min(BLOCKS, n // LEAST_ROWS), ceil(n / BLOCK_ROWS))
    curves.fit(matrix(sample.column(0).combine_chunks(), size), blocks)
    reach = max(0, ceil((WINDOW * blocks - 1) / 2))
    asking = members.where(F.col("id") % every == 0).select("point").distinct()
    slices = max(1, ceil(asking.count() * (2 * reach + 1) * USED / (CURVES * blocks * SLICE_QUERIES)))
    shared = spark.sparkContext.broadcast(curves)

    def indexed(batches):
        for batch in batches:
            keys, _ = shared.value.keys(matrix(batch.column("vector"), size))
            block = shared.value.blocks(keys).ravel()
            row = np.arange(batch.num_rows).repeat(CURVES)
            for s in range(slices):
                yield _placed(batch, row, np.tile(np.arange(CURVES), batch.num_rows), block, np.full(len(row), s))

    def asked(batches):
        for batch in batches:
            keys, apart = shared.value.keys(matrix(batch.column("vector"), size), query=True)
            used = np.argsort(-apart, axis=1, kind="stable")[:, :USED]
            home = np.take_along_axis(shared.value.blocks(keys), used, axis=1)
            # Windows at the ends of a curve are moved inwards, not cut.
            first = np.clip(home - reach, 0, max(0, blocks - 2 * reach - 1))
            block = first[:, :, None] + np.arange(min(blocks, 2 * reach + 1))
            curve = np.broadcast_to(used[:, :, None], block.shape).ravel()
            row = np.arange(batch.num_rows).repeat(block[0].size)
            point = batch.column("point").to_numpy()
            yield _placed(batch, row, curve, block.ravel(), (point % 1_000_003 % slices)[row])

    def compare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            all_points = right.column("point").to_numpy()
            vectors = matrix(right.column("vector").combine_chunks(), size)
            # Equal products are cut at the smallest points, so the order matters.
            order = np.argsort(all_points, kind="stable")
            all_points, vectors = all_points[order], vectors[order]
            for i in range(0, left.num_rows, 256):
                some = left.slice(i, 256)
                scores = matrix(some.column("vector").combine_chunks(), size) @ vectors.T
                best = np.argsort(-scores, axis=1, kind="stable")[:, : k + 1]
                point = some.column("point").to_numpy().repeat(best.shape[1])
                taken = np.take_along_axis(scores, best, axis=1).ravel()
                parts.append((point, all_points[best.ravel()], taken))
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [[], [], []]
        types = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types)], ["point", "other", "score"])

    placed = points.select("point", "vector").mapInArrow(indexed, PLACED)
    queries = points.join(asking, "point").select("point", "vector").mapInArrow(asked, PLACED)
    by = ["curve", "block", "slice"]
    found = queries.groupBy(*by).cogroup(placed.groupBy(*by)).applyInArrow(compare, FOUND)
    found = found.groupBy("point", "other").agg(F.max("score").alias("score"))
    best = Window.partitionBy("point").orderBy(F.desc("score"), "other")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k + 1).drop("place")

    # Points become ids: of each point the k + 1 smallest, of each query point the best k + 1 of those.
    first = Window.partitionBy("point").orderBy("id")
    some = members.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    named = found.join(some.select(F.col("point").alias("other"), "id"), "other")
    listed = Window.partitionBy("point").orderBy(F.desc("score"), "id")
    named = named.withColumn("place", F.row_number().over(listed)).where(F.col("place") <= k + 1)
    lists = named.groupBy("point").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("found"))
    asked_ids = members.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), "point")
    own_out = F.slice(F.filter("found", lambda x: x["id"] != F.col("query_id")), 1, k)
    out = asked_ids.join(lists, "point").select("query_id", F.posexplode(own_out).alias("at", "one"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("one.id").alias("vec_id"), "one.score")


def _placed(batch: pa.RecordBatch, row, curve, block, slice_) -> pa.RecordBatch:
    ids = [pa.array(np.asarray(c, dtype=np.int32)) for c in (curve, block, slice_)]
    kept = [batch.column(c).take(pa.array(row)) for c in ("point", "vector")]
    return pa.record_batch([*ids, *kept], ["curve", "block", "slice", "point", "vector"])
