"""Best-fit packing of documents into sequences of a fixed number of tokens, by patterns of lengths.

Documents are encoded once, closed with an end id and cut where longer than a
sequence. Only the histogram of piece lengths (at most one row per token of a
sequence) reaches the driver. There few-document length patterns are enumerated,
their repeat counts fitted to the histogram by non-negative least squares and rounded
to what is there; the remaining lengths, and the room the patterns leave, are
packed best fit, longest first, still on counts. Patterns that use up lengths which the
rest would have needed can do worse than best fit alone, so that plan is made as well and
never exceeded. The plan says which ranks of each length go where, and every piece finds
its place by its rank.

Null and empty texts are one piece holding the end id alone. Null and repeated ids
are packed like any other. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.store import settle
from feedlake.llm.tokens import TokenIds, tokenizer_path
from feedlake.llm.workers import tidy

CAPACITY = 4096
END_ID = 1
#: Texts turned into Python strings at a time.
SLICE = 256
PIECES = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, local_rank bigint"
)


def pieces_of(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece; ``local_rank`` counts the pieces of a length within a partition."""
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, part = TokenIds(path), Counter(), TaskContext.get().partitionId()
        for batch in batches:
            ids, texts = batch.columns
            for i in range(0, len(texts), SLICE):
                rows = []
                for doc_id, text in zip(ids.slice(i, SLICE).to_pylist(), texts.slice(i, SLICE).to_pylist()):
                    data = encoder.encode(text) + end
                    for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                        own = data[at : at + 4 * capacity]
                        n = len(own) // 4
                        rows.append((doc_id, piece, at // 4, n, zlib.crc32(own), part, seen[n]))
                        seen[n] += 1
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), PIECE_TYPES)]
                yield pa.record_batch(columns, PIECE_NAMES)

    return docs.mapInArrow(tidy(cut), PIECES)


PIECE_NAMES = [x.split()[0] for x in PIECES.split(", ")]
PIECE_TYPES = [pa.int32() if x.endswith(" int") else pa.int64() for x in PIECES.split(", ")]


def patterns(lengths: list[int], capacity: int, choices: int = 8) -> list[tuple[int, ...]]:
    """Patterns of up to three lengths, the fullest first; the last length is repeated as often as it fits.

    For a longest length the second takes the best fit and evenly spread smaller ones, the third the best fit to the rest.
    """
    found = set()

    def fit(room: int, longest: int) -> int:
        return bisect_right(lengths, min(room, longest)) - 1

    for a in lengths:
        found.add((a,) * (capacity // a))
        last = fit(capacity - a, a)
        if last < 0:
            continue
        for i in {last, *np.linspace(0, last, choices).astype(int).tolist()}:
            b = lengths[i]
            found.add((a, *(b,) * ((capacity - a) // b)))
            third = fit(capacity - a - b, b)
            if third >= 0:
                c = lengths[third]
                found.add((a, b, *(c,) * ((capacity - a - b) // c)))
    return sorted(found, key=lambda p: (capacity - sum(p), p))


def fitted(shapes: list[tuple[int, ...]], counts: dict[int, int], sweeps: int = 60, settled: float = 0.5) -> np.ndarray:
    """Repeat counts of the patterns that fit the histogram best, by coordinate descent on non-negative least squares.

    It ends once no count changes by more than ``settled`` in a sweep; counts are rounded down afterwards.
    """
    left = {n: float(c) for n, c in counts.items()}
    times = np.zeros(len(shapes))
    columns = [list(Counter(s).items()) for s in shapes]
    norms = [sum(k * k for _, k in c) for c in columns]
    for _ in range(sweeps):
        most = 0.0
        for j, column in enumerate(columns):
            step = max(-times[j], sum(k * left[n] for n, k in column) / norms[j])
            if step:
                times[j] += step
                most = max(most, abs(step))
                for n, k in column:
                    left[n] -= k * step
        if most <= settled:
            break
    return times


Groups = list[tuple[tuple[int, ...], int]]


def best_fit(left: dict[int, int], groups: Groups, capacity: int) -> Groups:
    """The groups, and all lengths that are left packed into their room or new sequences: longest first, tightest room first."""
    left = dict(left)
    open_groups: dict[int, Groups] = {}  # by room
    for shape, n in groups:
        open_groups.setdefault(capacity - sum(shape), []).append((shape, n))
    rooms = sorted(open_groups)
    for x in sorted(left, reverse=True):
        while left[x] > 0:
            at = bisect_right(rooms, x - 1)
            if at < len(rooms):
                room = rooms[at]
                shape, n = open_groups[room].pop()
                if not open_groups[room]:
                    del open_groups[room]
                    rooms.pop(at)
                deep = min(room // x, left[x])
            else:
                # As many of this length as one sequence holds go in together.
                room, shape, deep = capacity, (), min(capacity // x, left[x])
                n = left[x] // deep
            used = min(n, left[x] // deep)
            left[x] -= used * deep
            for rest, group, m in ((room - x * deep, shape + (x,) * deep, used), (room, shape, n - used)):
                if m:
                    if rest not in open_groups:
                        rooms.insert(bisect_right(rooms, rest), rest)
                    open_groups.setdefault(rest, []).append((group, m))
    return [g for groups in open_groups.values() for g in groups]


#: Room, as a share of a sequence, that the patterns of a plan may leave.
WASTES = (0.0, 0.0005, 0.002, 0.01)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Groups:
    """Groups of lengths that share a sequence, with how many such sequences there are.

    Patterns that leave little room are fitted to the histogram, rounded to what is there,
    and the rest is packed best fit. Of the plans for each share of room allowed the one
    with the fewest sequences is taken, or that without patterns if it has fewer still.
    """
    shapes = patterns(sorted(counts), capacity)
    plans = []
    for waste in WASTES:
        full = [s for s in shapes if capacity - sum(s) <= waste * capacity]
        left, groups = dict(counts), []
        for shape, times in zip(full, fitted(full, counts)):
            n = min(int(times + 0.5), *(left[x] // k for x, k in Counter(shape).items()))
            if n > 0:
                for x in shape:
                    left[x] -= n
                groups.append((shape, n))
        plans.append(best_fit(left, groups, capacity))
    plans.append(best_fit(counts, [], capacity))
    return min(plans, key=lambda groups: sum(n for _, n in groups))


def runs(groups: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Rows ``length, first rank, first sequence, offset``, by length and rank."""
    rows, used, sequence = [], Counter(), 0
    for shape, n in groups:
        at = 0
        for x in shape:
            rows.append((x, used[x], sequence, at))
            used[x] += n
            at += x
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


def place(ranked: DataFrame, table: np.ndarray) -> DataFrame:
    """The sequence and offset of each piece, by its length and its rank among pieces of that length."""
    shared = ranked.sparkSession.sparkContext.broadcast(table)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, sequence, offset = shared.value.T
        starts = (length << 48) + first
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            run = np.searchsorted(starts, (batch.column("length").to_numpy() << 48) + rank, side="right") - 1
            kept = [batch.column(n) for n in OUT_NAMES[:5]]
            found = [pa.array(sequence[run] + rank - first[run]), pa.array(offset[run])]
            yield pa.record_batch(kept + found, OUT_NAMES)

    return ranked.mapInArrow(tidy(look_up), OUT)


OUT = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
OUT_NAMES = [x.split()[0] for x in OUT.split(", ")]


def pack(
    docs: DataFrame,
    tokenizer: str = "word_bpe_49k.json",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` per piece."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")))
    pieces = settle(pieces_of(texts, tokenizer_path(tokenizer), capacity, end_id), "pieces")
    # A length may be that of a third of all pieces, so ranks come from counts per partition, not from sorting them.
    tally = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tally.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    histogram = {r.length: r.n for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    ranked = pieces.join(offsets, ["length", "part"]).withColumn("rank", F.col("local_rank") + F.col("before"))
    return place(ranked, runs(plan(histogram, capacity)))
