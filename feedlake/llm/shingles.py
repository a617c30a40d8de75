"""Sets of word shingles as sorted 64-bit hashes, over whole batches of texts at once.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased; a text's set holds its
distinct runs of five words, or the whole sequence where it has fewer words. A word's
hash is a polynomial over its bytes, each replaced by a fixed random 64-bit number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 5
_RANDOM = np.random.default_rng(20240229)
_LETTERS = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_LETTERS[ord("A") : ord("Z") + 1] = _LETTERS[ord("a") : ord("z") + 1]
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BASE = int(_RANDOM.integers(0, 2**63)) * 8 + 5  # odd, so that it can be divided by
_BASE &= 2**64 - 1
_STEP = [np.uint64(int(x) | 1) for x in _RANDOM.integers(0, 2**63, 16)]


def mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers under which near ones become unrelated."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.full(n, base & (2**64 - 1), dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts ``data[offsets[i]:offsets[i + 1]]``, and how many each text has."""
    letter = ~_SPACE[data]
    edge = letter.copy()
    edge[1:] &= ~letter[:-1]
    first = offsets[:-1][offsets[:-1] < len(data)]
    edge[first] = letter[first]  # a text's first letter starts a word whatever the text before ends with
    starts = np.flatnonzero(edge)
    # A word ends where the next character isn't a letter of the same text.
    after = np.append(~letter[1:], True)
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    ends = np.flatnonzero(letter & after) + 1
    powers = _powers(len(data) + 1, _BASE)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_LETTERS[data] * powers[:-1], out=sums[1:])
    inverse = _powers(len(data) + 1, pow(_BASE, -1, 2**64))
    hashes = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
    counts = np.diff(np.searchsorted(starts, offsets))
    return hashes, counts


def pieces(texts: pa.Array, size: int = 500_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Word hashes of some texts at a time (about ``size`` bytes): the first one's place, the hashes, words per text."""
    column = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + size, side="right")) - 1)
        yield i, *word_hashes(data[bounds[i] : bounds[j]], bounds[i : j + 1] - bounds[i])
        i = j


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` words."""
    out = hashes[: max(0, len(hashes) - length + 1)] * _STEP[0]
    for k in range(1, length):
        out = out + hashes[k : k + len(out)] * _STEP[k]
    return mix(out)


def sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The shingle set of each text, in order; null is an empty text."""
    for _, hashes, counts in pieces(texts):
        shingles, at = runs(hashes, WORDS), 0
        for count in counts.tolist():
            if count >= WORDS:
                yield np.unique(shingles[at : at + count - WORDS + 1])
            elif count:
                whole = np.array([count], dtype=np.uint64)
                for k in range(at, at + count):
                    whole = mix(whole + hashes[k])
                yield whole
            else:
                yield np.zeros(0, dtype=np.uint64)
            at += count
