"""Vector codes: every part of a vector becomes the index of the nearest entry of its codebook.

The codebooks are refined by rounds of assigning all parts and taking means. Blocks of
vectors get one metric tree per part, built middle-out once: about the square root of
its points become anchors, each owning the points nearest to it; anchors are parted
further below and merged two by two above. Every ball keeps the sum and count of its
points. A round hands the codebook down the trees: a ball inherits the entries that may
be nearest to some point of its parent and drops those that can't be to its own; a ball
left with one entry is its as a whole, and gives its cached sum and count without a look
at its points. What reaches a leaf is compared exactly, in integers. All nodes of a
level are handled as arrays.

What leaves a task per round is at most one row per part and entry, whatever it read; the
codebooks, whose size the parameters fix, are all that is collected or sent out.

Rows whose vector is null or holds a null or non-finite component give no row; nor do
rows of another length than the kept vector of the smallest id, or of a length that
the number of parts doesn't divide. Null ids are coded but start no entry. Of rows that
share an id the smaller vector counts as the earlier. With fewer kept ids than entries
the codebooks are shorter. Components so large that distances don't fit 64 bits are
refused with an error. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.store import settle

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors of one block, and points that a ball may hold without being parted.
BLOCK, LEAF = 8192, 48
#: Rows of the sums per label that may be broadcast; more are joined by shuffle.
BROADCAST_ROWS = 200_000
#: Arrays that make up a tree, each kept as bytes.
TREE = {
    "order": "<i4", "points": "<i8", "left": "<i4", "right": "<i4", "start": "<i4", "end": "<i4",
    "centre": "<f8", "radius": "<f8", "sums": "<i8",
}
CODES = "vec_id bigint, label {label}, code string, error bigint"


def _length(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


class _Growing:
    """A tree while it is built: balls with their children or, in leaves, their points."""

    def __init__(self, points: np.ndarray, leaf: int):
        self.points, self.leaf = points, leaf
        self.real = points.astype(np.float64)
        self.balls: list[tuple] = []  # left, right, members of a leaf, sum, count, centre, radius

    def _add(self, left, right, members, total, count, centre, radius) -> int:
        self.balls.append((left, right, members, total, count, centre, radius))
        return len(self.balls) - 1

    def grow(self, members: np.ndarray) -> int:
        """The ball of the given points, with all below it."""
        total = self.points[members].sum(axis=0)
        centre = total / len(members)
        own = self.real[members]
        radius = float(_length(own - centre).max())
        if len(members) <= self.leaf or radius == 0:
            return self._add(-1, -1, members, total, len(members), centre, radius)
        owner = self._anchors(own)
        groups = np.split(np.argsort(owner, kind="stable"), np.cumsum(np.bincount(owner))[:-1])
        return self._merged([self.grow(members[g]) for g in groups if len(g)])

    @staticmethod
    def _anchors(own: np.ndarray) -> np.ndarray:
        """The anchor that owns each point; every new anchor is the point farthest from its own one."""
        wanted = int(np.ceil(np.sqrt(len(own))))
        pivots = np.empty((wanted, own.shape[1]))
        pivots[0] = own[0]
        owner = np.zeros(len(own), dtype=np.int64)
        apart = _length(own - own[0])
        for k in range(1, wanted):
            far = int(apart.argmax())
            if apart[far] == 0:
                break
            pivots[k] = own[far]
            gaps = _length(pivots[:k] - own[far])
            # A point nearer to its anchor than half the way to the new one can't change hands.
            may = np.flatnonzero(apart > gaps[owner] / 2)
            new = _length(own[may] - own[far])
            moves = new < apart[may]
            owner[may[moves]] = k
            apart[may[moves]] = new[moves]
        return owner

    def _merged(self, nodes: list[int]) -> int:
        """One ball over all nodes: the two whose common ball is smallest are merged first."""
        width = self.points.shape[1]
        nodes = list(nodes)
        n = len(nodes)
        sums = np.array([self.balls[i][3] for i in nodes]).reshape(n, width)
        counts = np.array([self.balls[i][4] for i in nodes])
        centres = np.array([self.balls[i][5] for i in nodes]).reshape(n, width)
        radii = np.array([self.balls[i][6] for i in nodes])
        alive = np.ones(n, dtype=bool)

        def cost(i: int) -> np.ndarray:
            joint = (centres * counts[:, None] + centres[i] * counts[i]) / (counts + counts[i])[:, None]
            out = np.maximum(_length(joint - centres) + radii, _length(joint - centres[i]) + radii[i])
            out[~alive] = np.inf
            out[i] = np.inf
            return out

        costs = np.array([cost(i) for i in range(n)]).reshape(n, n)
        for _ in range(n - 1):
            i, j = divmod(int(costs.argmin()), n)
            radius = float(costs[i, j])
            sums[i] += sums[j]
            counts[i] += counts[j]
            centres[i], radii[i], alive[j] = sums[i] / counts[i], radius, False
            nodes[i] = self._add(nodes[i], nodes[j], None, sums[i].copy(), int(counts[i]), centres[i].copy(), radius)
            costs[j, :] = costs[:, j] = np.inf
            costs[i, :] = costs[:, i] = cost(i)
        return nodes[int(np.flatnonzero(alive)[0])]


def grown(points: np.ndarray, leaf: int = LEAF) -> dict[str, np.ndarray]:
    """The tree of points as arrays: the root first, points in the order of the leaves."""
    tree = _Growing(points, leaf)
    root = tree.grow(np.arange(len(points)))
    rows, order, at, todo = [], [], 0, [(root, -1, 0)]
    while todo:
        ball, parent, side = todo.pop()
        left, right, members, total, count, centre, radius = tree.balls[ball]
        me = len(rows)
        rows.append([-1, -1, at, at + count, centre, radius, total])
        if parent >= 0:
            rows[parent][side] = me
        if members is None:
            todo += [(right, me, 1), (left, me, 0)]
        else:
            order.append(members)
            at += count
    found = dict(zip(("left", "right", "start", "end", "centre", "radius", "sums"), map(np.array, zip(*rows))))
    found["order"] = np.concatenate(order)
    found["points"] = points[found["order"]]
    return {name: np.ascontiguousarray(found[name], dtype=kind) for name, kind in TREE.items()}


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...``, ``sizes[i]`` of them, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) + np.repeat(starts - before, sizes)


def handed_down(tree: dict[str, np.ndarray], book: np.ndarray):
    """``whole balls, their entries, points compared at leaves, their entries`` of one tree and codebook."""
    real = book.astype(np.float64)
    entry = np.arange(len(book))
    ball = np.zeros(len(book), dtype=np.int64)
    whole, whole_entry, at_leaf, leaf_entry = [], [], [], []
    while len(ball):
        first = np.flatnonzero(np.concatenate([[True], ball[1:] != ball[:-1]]))
        group = np.repeat(np.arange(len(first)), np.diff(first, append=len(ball)))
        apart = _length(tree["centre"][ball] - real[entry])
        radius = tree["radius"][ball]
        best = np.minimum.reduceat(apart, first)[group]
        # The margin covers rounding, so no entry is dropped that is as near as the nearest.
        keep = apart <= best + 2 * radius + 1e-6 * (1 + best + radius)
        ball, entry = ball[keep], entry[keep]
        sizes = np.bincount(group[keep], minlength=len(first))
        of = np.repeat(np.arange(len(first)), sizes)
        alone, leaf = sizes[of] == 1, tree["left"][ball] < 0
        whole.append(ball[alone])
        whole_entry.append(entry[alone])
        ends = np.flatnonzero(leaf & ~alone)
        if len(ends):
            points, entries = _compared(tree, book, ball[ends], entry[ends])
            at_leaf.append(points)
            leaf_entry.append(entries)
        down = ~leaf & ~alone
        ball, entry = ball[down], entry[down]
        ball, entry = np.concatenate([tree["left"][ball], tree["right"][ball]]), np.concatenate([entry, entry])
    nothing = [np.zeros(0, np.int64)]
    return tuple(np.concatenate(x or nothing) for x in (whole, whole_entry, at_leaf, leaf_entry))


def _compared(tree, book, ball, entry) -> tuple[np.ndarray, np.ndarray]:
    """Points of leaves with the nearest entry of their leaf's list; equal distances go to the lower index."""
    first = np.flatnonzero(np.concatenate([[True], ball[1:] != ball[:-1]]))
    listed = np.diff(first, append=len(ball))
    leaf = ball[first]
    held = tree["end"][leaf] - tree["start"][leaf]
    points = _ragged(tree["start"][leaf], held)
    per_point = np.repeat(listed, held)
    tried = entry[_ragged(np.repeat(first, held), per_point)]
    gaps = tree["points"][np.repeat(points, per_point)] - book[tried]
    key = np.einsum("ij,ij->i", gaps, gaps) * len(book) + tried
    return points, np.minimum.reduceat(key, np.cumsum(per_point) - per_point) % len(book)


def nearest_entries(tree: dict[str, np.ndarray], book: np.ndarray) -> np.ndarray:
    """The entry of each point, in the order in which the points were given."""
    whole, whole_entry, points, entries = handed_down(tree, book)
    found = np.empty(len(tree["order"]), dtype=np.int64)
    sizes = tree["end"][whole] - tree["start"][whole]
    found[_ragged(tree["start"][whole], sizes)] = np.repeat(whole_entry, sizes)
    found[points] = entries
    out = np.empty_like(found)
    out[tree["order"]] = found
    return out


def gathered(tree: dict[str, np.ndarray], book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and number of the points of each entry."""
    whole, whole_entry, points, entries = handed_down(tree, book)
    sums, counts = np.zeros(book.shape, dtype=np.int64), np.zeros(len(book), dtype=np.int64)
    np.add.at(sums, whole_entry, tree["sums"][whole])
    np.add.at(counts, whole_entry, tree["end"][whole] - tree["start"][whole])
    np.add.at(sums, entries, tree["points"][points])
    np.add.at(counts, entries, 1)
    return sums, counts


def _scaled(vectors: np.ndarray, scale: int, entries: int, parts: int) -> np.ndarray:
    """Integer components; refuses those whose distances would leave 64 bits."""
    scaled = np.floor(vectors * scale)
    width = max(1, vectors.shape[-1] // parts)
    bound = np.sqrt(2.0**61 / (width * max(entries, 1))) / 2
    if scaled.size and np.abs(scaled).max() >= bound:
        raise ValueError(f"a component is beyond {bound / scale:.0f}, where distances no longer fit 64 bits")
    return scaled.astype(np.int64)


def _bytes(tree: dict[str, np.ndarray]) -> dict[str, bytes]:
    return {name: tree[name].tobytes() for name in TREE}


def _tree(kept: dict[str, bytes], width: int) -> dict[str, np.ndarray]:
    tree = {name: np.frombuffer(kept[name], kind) for name, kind in TREE.items()}
    return {n: a.reshape(-1, width) if n in ("points", "centre", "sums") else a for n, a in tree.items()}


def forest(
    vectors: DataFrame, parts: int, width: int, scale: int, entries: int, size: int = BLOCK, leaf: int = LEAF
) -> DataFrame:
    """Blocks of ``vec_id, label, vector``: lists of ids and labels, and one tree per part."""
    label = vectors.schema["label"].dataType.simpleString()
    schema = f"vec_id array<bigint>, label array<{label}>, trees array<struct<{', '.join(f'{n}: binary' for n in TREE)}>>"

    def block(ids: pa.Array, labels: pa.Array, rows: np.ndarray) -> pa.RecordBatch:
        points = _scaled(rows, scale, entries, parts).reshape(len(rows), parts, width)
        trees = [_bytes(grown(np.ascontiguousarray(points[:, p]), leaf)) for p in range(parts)]
        ends = pa.array([0, len(rows)], pa.int32())
        kept = pa.array([trees], pa.list_(pa.struct([(n, pa.binary()) for n in TREE])))
        columns = [pa.ListArray.from_arrays(ends, ids), pa.ListArray.from_arrays(ends, labels), kept]
        return pa.record_batch(columns, ["vec_id", "label", "trees"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal held, n
            table = pa.Table.from_batches(held).combine_chunks()
            held, n = [], 0
            for i in range(0, len(table), size):
                ids, labels, vector = (c.combine_chunks() for c in table.slice(i, size).columns)
                yield block(ids, labels, vector.flatten().to_numpy(zero_copy_only=False).reshape(-1, parts * width))

        for batch in batches:
            for i in range(0, batch.num_rows, size):
                held.append(batch.slice(i, size))
                n += held[-1].num_rows
                if n >= size:
                    yield from close()
        if n:
            yield from close()

    return vectors.mapInArrow(blocks, schema)


def _refined(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: means of the parts assigned to each entry, rounded down."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros_like(books), np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for row in batch.column("trees"):
                for p, kept in enumerate(row):
                    own, n = gathered(_tree({k: v.as_buffer() for k, v in kept.items()}, width), books[p])
                    total[p] += own
                    count[p] += n
        p, e = np.nonzero(count)
        columns = [pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e])]
        yield pa.record_batch([*columns, *(pa.array(total[p, e, x]) for x in range(width))], names)

    names = ["part", "entry", "n", *(f"s{x}" for x in range(width))]
    schema = "part int, entry int, n bigint" + "".join(f", s{x} bigint" for x in range(width))
    found = blocks.select("trees").mapInArrow(sums, schema).groupBy("part", "entry")
    after = books.copy()
    for r in found.agg(*(F.sum(c).alias(c) for c in names[2:])).collect():
        after[r.part, r.entry] = [r[f"s{x}"] // r.n for x in range(width)]
    return after


def _codes(blocks: DataFrame, books: np.ndarray, label: str) -> DataFrame:
    """:data:`CODES` of all vectors by the final codebooks."""
    parts, entries, width = books.shape
    hexes = np.array([f"{e:02x}" for e in range(entries)])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, labels, trees in zip(*(batch.column(c) for c in ("vec_id", "label", "trees"))):
                code, error = [], 0
                for p, kept in enumerate(trees):
                    tree = _tree({k: v.as_buffer() for k, v in kept.items()}, width)
                    found = nearest_entries(tree, books[p])
                    gaps = np.empty_like(tree["points"])
                    gaps[tree["order"]] = tree["points"]
                    gaps -= books[p][found]
                    error = error + np.einsum("ij,ij->i", gaps, gaps)
                    code.append(hexes[found])
                codes = pa.array(["".join(c) for c in zip(*(c.tolist() for c in code))], pa.string())
                yield pa.record_batch([ids.values, labels.values, codes, pa.array(error)], ["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(rows, CODES.format(label=label))


def vector_codes(
    vectors: DataFrame,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    block: int = BLOCK,
    leaf: int = LEAF,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` per kept row, and the final codebooks by part, entry and position.

    A code holds two hex digits per part, so there are at most 256 entries.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be from 1 to 256")
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    label = rows.schema["label"].dataType.simpleString()
    kept = rows.where(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % parts == 0) & F.coalesce(finite, F.lit(False)))
    named = kept.where("vec_id IS NOT NULL").orderBy("vec_id", "vector")
    size = F.size(v)
    first = named.select(size.alias("n")).first() or kept.select(size.alias("n")).first()
    if first is None:
        return vectors.sparkSession.createDataFrame([], CODES.format(label=label)), np.zeros((parts, 0, 0), np.int64)
    width = first.n // parts
    kept = kept.where(size == first.n)
    start = [r.vector for r in named.where(size == first.n).select("vector").limit(entries).collect()]
    if not start:  # no row has an id
        start = [r.vector for r in kept.orderBy("vector").select("vector").limit(entries).collect()]
    books = _scaled(np.array(start), scale, entries, parts).reshape(len(start), parts, width).transpose(1, 0, 2).copy()
    blocks = settle(forest(kept, parts, width, scale, entries, block, leaf), "metric-trees")
    for _ in range(rounds):
        books = _refined(blocks, books)
    return settle(_codes(blocks, books, label), "vector-codes"), books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with ``label_error``, the error summed over equal labels; nulls are one label."""
    totals = codes.groupBy(F.struct("label").alias("of")).agg(F.sum("error").alias("label_error"))
    totals = settle(totals, "label-errors")
    if totals.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        totals = F.broadcast(totals)
    return codes.join(totals, F.struct(codes["label"]).eqNullSafe(totals["of"])).drop("of")


def books_digest(books: np.ndarray) -> str:
    """SHA-256, in hex, of all components by part, entry and position, in decimal and joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
