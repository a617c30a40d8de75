"""Token ids in 64-bit words: four bits say how many ids a word holds, sixty hold them.

Every selector packs a fixed count of ids in slots of one width. An id fits a slot if it
is less than the slot's largest value; that value marks an escape, an id wider than
:data:`WIDEST` bits, which stands in a list of its own. So a wide id costs its neighbours
nothing. Ids are coded in blocks that begin on a word; the last word of a block is filled
up with zeros. Both directions work on whole arrays.
"""

from __future__ import annotations

import numpy as np

#: Ids per word and bits per id of each selector.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20)
#: Ids of more bits are escaped, and so is the largest of this many bits.
WIDEST = WIDTHS[-1]

_COUNTS = np.array(COUNTS, dtype=np.int64)
_LARGEST = np.array([(1 << w) - 1 for w in WIDTHS], dtype=np.uint64)


def _first_selectors() -> np.ndarray:
    """The densest selector whose slots an id fits, by id; an escaped id fits every slot."""
    out = np.searchsorted(_LARGEST, np.arange(1 << WIDEST, dtype=np.uint64), side="right").astype(np.uint8)
    out[-1] = 0
    return out


_FIRST = _first_selectors()


def _selectors(first: np.ndarray) -> np.ndarray:
    """For each position the densest selector that fits all ids its word would hold, from what each id needs alone."""
    n = len(first)
    spread = {1: first}  # the largest need among the next 1, 2, 4, ... ids
    for width in (2, 4, 8, 16, 32):
        half = spread[width // 2]
        spread[width] = np.maximum(half, np.append(half[width // 2 :], np.zeros(width // 2, np.uint8)))
    chosen = np.full(n, len(COUNTS) - 1, dtype=np.uint8)
    for s in range(len(COUNTS) - 2, -1, -1):
        count = COUNTS[s]
        width = 1 << (count.bit_length() - 1)
        whole, rest = spread[width], count - width
        most = np.maximum(whole, np.append(whole[rest:], np.zeros(rest, np.uint8))) if rest else whole
        chosen[most <= s] = s
    return chosen


def encode(ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, words before each block's end, escaped ids, and escapes before each block's end.

    ``ids`` are unsigned numbers of at most 32 bits, ``ends`` the ascending ends of the
    blocks; the last one is the number of ids. A block may be empty.
    """
    ends = np.asarray(ends, dtype=np.int64)
    if not len(ids):
        nothing = np.zeros(len(ends), dtype=np.int64)
        return np.zeros(0, np.uint64), nothing, np.zeros(0, np.uint32), nothing
    # Each block is followed by room for a word of zeros, so no word's need comes from the next block.
    room = COUNTS[0]
    sizes = np.diff(ends, prepend=0)
    shift = np.repeat(np.arange(len(ends)) * room, sizes)
    spaced = np.zeros(len(ids) + room * len(ends), dtype=np.uint64)
    at = np.arange(len(ids)) + shift
    largest = np.uint64((1 << WIDEST) - 1)
    spaced[at] = ids
    needs = _FIRST[np.minimum(spaced, largest)]
    chosen = _selectors(needs)
    step = _COUNTS[chosen].tolist()
    starts, word_ends = [], []
    for i, (end, size) in enumerate(zip((ends + np.arange(len(ends)) * room).tolist(), sizes.tolist())):
        x = end - size
        while x < end:
            starts.append(x)
            x += step[x]
        word_ends.append(len(starts))
    starts = np.array(starts, dtype=np.int64)
    selectors = chosen[starts]
    words = selectors.astype(np.uint64) << np.uint64(60)
    escaped = spaced >= largest
    any_escaped = bool(escaped.any())
    for s in np.unique(selectors).tolist():
        own = np.flatnonzero(selectors == s)
        first = starts[own]
        packed = words[own]
        for slot in range(COUNTS[s]):
            value = spaced[first + slot]
            if any_escaped:
                value = np.minimum(value, _LARGEST[s])
            packed |= value << np.uint64(slot * WIDTHS[s])
        words[own] = packed
    escape_ends = np.cumsum(np.append(0, escaped[at]))[ends]
    return words, np.array(word_ends, dtype=np.int64), spaced[escaped].astype(np.uint32), escape_ends


def decode(words: np.ndarray, word_ends: np.ndarray, ends: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of whole blocks, from what :func:`encode` gave."""
    n = int(ends[-1]) if len(ends) else 0
    out = np.zeros(n, dtype=np.uint32)
    if not n:
        return out
    selectors = (words >> np.uint64(60)).astype(np.int64)
    held = _COUNTS[selectors]
    # A word's place is its block's start and what the words before it in the block hold.
    before = np.concatenate([[0], np.cumsum(held)])
    first_word = np.concatenate([[0], word_ends[:-1]])
    words_of = np.diff(word_ends, prepend=0)
    shift = np.concatenate([[0], ends[:-1]]) - before[first_word]
    starts = before[:-1] + np.repeat(shift, words_of)
    held = np.minimum(held, np.repeat(ends, words_of) - starts)
    escaped = np.zeros(n, dtype=bool) if len(escapes) else None
    for s in np.unique(selectors):
        own = np.flatnonzero(selectors == s)
        for slot in range(COUNTS[s]):
            some = own[slot < held[own]]
            value = (words[some] >> np.uint64(slot * WIDTHS[s])) & _LARGEST[s]
            out[starts[some] + slot] = value
            if escaped is not None:
                escaped[starts[some] + slot] = value == _LARGEST[s]
    if escaped is not None:
        out[escaped] = escapes
    return out
