"""Fill-in-middle transformation: documents cut at two line boundaries and put together in another order.

Where the lines of a text end is held as a compressed set of offsets, split by their
high 16 bits into containers: sorted arrays, bitmaps or runs, whichever is smallest. The
cumulative cardinalities of the containers say which one holds the k-th boundary, and a
selection inside it gives the offset, so a cut is two searches however many lines
there are. Cuts, form and order follow from a digest of the document's id alone, so a
retried task gives the same rows.

Null and empty texts, and texts that hold one of the three markers, keep their text
(form ``plain``). A null id is digested as if it were an empty text. Rows that share an id
share their cuts' digest and each give a row. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Markers before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Percentage of texts that are cut, and of those that begin with the suffix.
RATE, SUFFIX_FIRST = 100, 50
#: Texts turned into Python strings at a time.
SLICE = 256
LOW = 1 << 16
OUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
OUT_NAMES = [x.split()[0] for x in OUT.split(", ")]
OUT_TYPES = [pa.string() if x.endswith("string") else pa.int64() for x in OUT.split(", ")]


class ArrayContainer:
    """The low halves of the members, ascending."""

    def __init__(self, lows: np.ndarray):
        self.lows = lows.astype(np.uint16)

    @staticmethod
    def size(lows: np.ndarray) -> int:
        return 2 * len(lows)

    def select(self, k: int) -> int:
        return int(self.lows[k])


class BitmapContainer:
    """One bit for each of the 65,536 low halves, with the number of members before each word."""

    def __init__(self, lows: np.ndarray):
        bits = np.zeros(LOW, dtype=np.uint8)
        bits[lows] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    @staticmethod
    def size(lows: np.ndarray) -> int:
        return LOW // 8

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, side="right")) - 1
        bits, left = int(self.words[word]), k - int(self.before[word])
        for _ in range(left):
            bits &= bits - 1
        return 64 * word + (bits & -bits).bit_length() - 1


class RunContainer:
    """First members of unbroken runs, with the number of members before each run."""

    def __init__(self, lows: np.ndarray):
        first = run_starts(lows)
        self.starts = lows[first].astype(np.uint16)
        self.before = first

    @staticmethod
    def size(lows: np.ndarray) -> int:
        return 4 * len(run_starts(lows))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


def run_starts(lows: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([[True], lows[1:] != lows[:-1] + 1]))


KINDS = (ArrayContainer, RunContainer, BitmapContainer)


class BoundarySet:
    """Strictly ascending offsets that can be asked for the k-th one."""

    def __init__(self, offsets: np.ndarray):
        high, low = offsets >> 16, offsets & (LOW - 1)
        # Most texts are shorter than a container's span.
        inner = np.flatnonzero(high[1:] != high[:-1]) + 1 if len(high) and high[-1] != high[0] else np.zeros(0, np.int64)
        parts = np.split(low, inner) if len(offsets) else []
        self.highs = high[np.concatenate([[0], inner])] if len(offsets) else high
        self.containers = [min(KINDS, key=lambda kind: kind.size(part))(part) for part in parts]
        self.before = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        at = int(np.searchsorted(self.before, k, side="right")) - 1
        return int(self.highs[at]) * LOW + self.containers[at].select(k - int(self.before[at]))


def line_ends(text: str) -> BoundarySet:
    """Offsets, in code points, after each line; the last line may lack its line feed."""
    points = np.frombuffer(text.encode(), np.uint8) if text.isascii() else np.frombuffer(text.encode("utf-32-le"), "<u4")
    ends = np.flatnonzero(points == 10) + 1
    if len(points) and (not len(ends) or ends[-1] != len(points)):
        ends = np.append(ends, len(points))
    return BoundarySet(ends)


def drawn(doc_id: int | None, seed: int) -> tuple[int, int, int, int]:
    """Four 32-bit numbers that follow from the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in range(0, 32, 8))


def transform(doc_id: int | None, text: str, seed: int, rate: int, suffix_first: int):
    """``n, form, prefix_chars, middle_chars, output`` of one text."""
    ends = line_ends(text)
    n = len(ends)
    one, two, cut, order = drawn(doc_id, seed)
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or cut % 100 >= rate:
        return n, "plain", None, None, text
    first, last = sorted((one % (n + 1), two % (n + 1)))
    a, b = (ends.select(k - 1) if k else 0 for k in (first, last))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if order % 100 < suffix_first:
        return n, "spm", a, b - a, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", a, b - a, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    rate: int = RATE,
    suffix_first: int = SUFFIX_FIRST,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` per row; ``n`` counts lines."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, SLICE):
                ids, texts = (c.slice(i, SLICE).to_pylist() for c in batch.columns)
                made = [(d, *transform(d, t, seed, rate, suffix_first)) for d, t in zip(ids, texts)]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*made), OUT_TYPES)], OUT_NAMES)

    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(rows, OUT)


def restored(output: Column, form: Column) -> Column:
    """The text that an output of a form was made from."""

    def parted(first: str, second: str) -> tuple[Column, Column, Column]:
        """What follows the leading marker, the next one and the last one."""
        body = F.substring(output, len(first) + 1, 2**31 - 1)
        a = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(a) + len(second) + 1)
        b = F.substring_index(rest, MIDDLE, 1)
        return a, b, F.substr(rest, F.length(b) + len(MIDDLE) + 1)

    prefix, suffix, middle = parted(PREFIX, SUFFIX)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parted(SUFFIX, PREFIX)
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
