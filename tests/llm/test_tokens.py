"""Chunked encoding, token counts with their cache, and packing."""

import bisect
import random
import struct
import sys
import zlib

import numpy as np
import pytest
from feedlake.llm import packing, token_counts
from feedlake.llm.tokens import TokenCounter, TokenIds, tokenizer_path
from rows import AWKWARD, documents
from tokenizers import Tokenizer

PARTS = [
    " ", "  ", "\n", "\t", "\r\n", "a", "don't", "É", "é", "́", "<|endoftext|>", "<|startoftext|>", "\xa0", "\x1c", "...",
    "!?", "12", "3", "ßΣς", "日本", "​", "😀", "'s", "x's ", " \n ", " ", "İ", "ª", "²", "ŉ", "Œ", "hello,", "\x85",
]


def library(name):
    return Tokenizer.from_file(tokenizer_path(name))


@pytest.mark.parametrize(("name", "kind"), [("byte_bpe_50k.json", TokenCounter), ("word_bpe_49k.json", TokenIds)])
def test_same_ids_as_the_library(name, kind):
    rng, whole, own = random.Random(4), library(name), kind(tokenizer_path(name), memory=100)
    for _ in range(4000):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 9)))
        ids = whole.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == (len(ids) if kind is TokenCounter else struct.pack(f"<{len(ids)}I", *ids)), text


def test_a_new_word_takes_one_call():
    rng, own, calls = random.Random(6), TokenIds(tokenizer_path("word_bpe_49k.json")), []
    words = sorted({"".join(rng.choices("abcdeéü", k=9)) for _ in range(500)})
    sys.setprofile(lambda frame, event, _: event == "call" and calls.append(frame.f_code.co_name))
    try:
        own.encode(" ".join(words))
    finally:
        sys.setprofile(None)
    # The call for a word, and that which packs its ids.
    assert len(calls) <= 2 * len(words) + 20


def test_counts_and_cache(spark, tmp_path):
    cache, docs, whole = str(tmp_path / "cache"), documents(spark, AWKWARD), library("byte_bpe_50k.json")
    want = sorted(
        (str(i), len((t or "").encode()), n := len(whole.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in AWKWARD
    )
    for _ in range(2):
        got = sorted((str(r.doc_id), *r[1:]) for r in token_counts.count_tokens(docs, cache).collect())
        assert got == want
        assert spark.read.parquet(cache).count() == len({t or "" for _, t in AWKWARD})  # the second run adds nothing
    more = documents(spark, [(9, "new words here"), (1, AWKWARD[0][1])])
    assert {r.doc_id for r in token_counts.count_tokens(more, cache).collect()} == {1, 9}
    assert spark.read.parquet(cache).count() == len({t or "" for _, t in AWKWARD}) + 1


def test_counts_of_nothing(spark, tmp_path):
    assert token_counts.count_tokens(documents(spark, []), str(tmp_path / "none")).count() == 0


def check_packing(rows, texts, capacity):
    whole, sequences = library("word_bpe_49k.json"), {}
    pieces = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    for i, text in texts:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        data = struct.pack(f"<{len(ids)}I", *ids)
        want = [
            (at // capacity, at, min(capacity, len(ids) - at), zlib.crc32(data[4 * at : 4 * (at + capacity)]))
            for at in range(0, len(ids), capacity)
        ]
        got = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in pieces[i])
        assert got == sorted(want * sum(j == i for j, _ in texts))
    return len(sequences)


def test_packing_keeps_everything(spark):
    rows = packing.pack(documents(spark, AWKWARD)).collect()
    check_packing(rows, AWKWARD, packing.CAPACITY)
    assert packing.pack(documents(spark, [])).count() == 0


def test_packing_is_tight(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = packing.pack(docs, capacity=1000).collect()
    n = check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 1000)
    assert n <= -(-sum(r.length for r in rows) // 1000) * 1.01 + 1


def best_fit_plainly(counts, capacity):
    """Sequences that best-fit decreasing takes, item by item."""
    rooms = []
    for x in sorted(counts, reverse=True):
        for _ in range(counts[x]):
            at = bisect.bisect_left(rooms, x)
            room = rooms.pop(at) if at < len(rooms) else capacity
            bisect.insort(rooms, room - x)
    return len(rooms)


def least_sequences(counts, capacity):
    """A number of sequences below which no packing goes: by volume, by long lengths, by dual feasible functions."""
    xs = np.array(sorted(counts))
    ns = np.array([counts[x] for x in xs.tolist()], dtype=float)
    best = np.ceil((xs * ns).sum() / capacity)
    for k in {0, *xs[2 * xs <= capacity].tolist()}:
        large, small = 2 * xs > capacity, (xs >= k) & (2 * xs <= capacity)
        room = ((capacity - xs) * ns)[large & (xs <= capacity - k)].sum()
        best = max(best, ns[large].sum() + max(0, np.ceil(((xs * ns)[small].sum() - room) / capacity)))
    for k in range(1, 60):
        scaled = xs * (k + 1) / capacity
        whole = np.isclose(scaled, np.round(scaled))
        best = max(best, np.ceil((np.where(whole, xs / capacity, np.floor(scaled) / k) * ns).sum() - 1e-6))
    return int(best)


def test_plans_place_each_length_once_and_beat_best_fit():
    worst = 0
    for seed in range(200):
        rng = random.Random(seed)
        capacity = rng.choice([5, 64, 1000, 4096])
        low, high = rng.choice([(1, capacity), (max(1, capacity // 8), capacity), (1, max(1, capacity // 3))])
        counts = {rng.randint(low, high): rng.randint(1, 60) for _ in range(60)}
        groups = packing.plan(counts, capacity)
        used = dict.fromkeys(counts, 0)
        for shape, n in groups:
            assert sum(shape) <= capacity and n > 0
            for x in shape:
                used[x] += n
        assert used == counts
        made = sum(n for _, n in groups)
        assert made <= best_fit_plainly(counts, capacity)
        if capacity == 4096:
            worst = max(worst, made / least_sequences(counts, capacity))
    assert worst < 1.05


def test_patterns_alone_fill_what_they_can():
    counts = {3000: 500, 1096: 500, 2048: 300, 1365: 900, 1366: 300}
    full = [s for s in packing.patterns(sorted(counts), 4096) if sum(s) == 4096]
    times = dict(zip(full, packing.fitted(full, counts)))
    assert round(times[3000, 1096]) == 500 and round(times[2048, 2048]) == 150
    assert sum(n for _, n in packing.plan(counts)) == -(-sum(x * n for x, n in counts.items()) // 4096)
