"""Vector codes, token files and the fill-in-middle transformation against plain Python."""

import hashlib
import json
import random
import re
import zlib

import numpy as np
import pytest
from feedlake.llm import infill, simple8b, token_files, vector_codes
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from rows import AWKWARD, documents
from tokenizers import Tokenizer

# --- fill in the middle --------------------------------------------------------------


@pytest.mark.parametrize("step", [1, 3, 9, 40])
def test_boundary_sets_give_every_member(step):
    rng = np.random.default_rng(step)
    sparse = np.flatnonzero(rng.random(300_000) < 1 / step)
    runs = np.concatenate([np.arange(70_000, 70_000 + 20_000 * step), [5_000_000]])
    for members in (sparse, runs, sparse[:1], sparse[:0]):
        found = infill.BoundarySet(members)
        assert len(found) == len(members)
        for k in {0, len(members) - 1, *rng.integers(0, max(1, len(members)), 300).tolist()}:
            if 0 <= k < len(members):
                assert found.select(k) == members[k]


def test_each_kind_of_container_is_used():
    span = np.arange(1 << 16)
    rng = np.random.default_rng(0)
    kinds = [span[:9000], span[::100], span[rng.random(1 << 16) < 0.4]]
    made = [type(infill.BoundarySet(k).containers[0]) for k in kinds]
    assert made == [infill.RunContainer, infill.ArrayContainer, infill.BitmapContainer]


def cut_plainly(doc_id, text):
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, len(lines), "plain", None, None, text
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (lines[:a], lines[a:b], lines[b:]))
    if h[3] % 100 < 50:
        return doc_id, len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


LINES = ["", "a\n", "\n\n\n", "b<", "<S", ">P", "日本\nÉ", "<P>", "x\r\ny", "P>\n<", "<M", "\x00\n", "end", "😀\n"]


def test_infill_is_that_of_the_rule(spark):
    rng = random.Random(3)
    rows = AWKWARD + [(100 + n, "".join(rng.choices(LINES, k=rng.randint(0, 8)))) for n in range(400)]
    made = infill.fill_in_middle(documents(spark, rows))
    got = made.select("*", infill.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert sorted(map(str, (tuple(r[:-1]) for r in got))) == sorted(map(str, (cut_plainly(i, t or "") for i, t in rows)))
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(t or "")
    assert all(r.back in texts[r.doc_id] for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert infill.fill_in_middle(documents(spark, [])).count() == 0
    some = infill.fill_in_middle(documents(spark, rows), rate=50, suffix_first=0).groupBy("form").count().collect()
    assert {r.form for r in some} == {"plain", "psm"}


# --- token files -----------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 2**16), st.integers(0, 2**32 - 1)), max_size=150), min_size=1, max_size=5))
def test_words_give_back_their_ids(blocks):
    ends = np.cumsum([len(b) for b in blocks])
    ids = np.array([x for b in blocks for x in b], dtype=np.uint32)
    words, word_ends, escapes, escape_ends = simple8b.encode(ids, ends)
    assert simple8b.decode(words, word_ends, ends, escapes).tolist() == ids.tolist()
    assert len(escapes) == sum(x >= 2**20 - 1 for x in ids.tolist()) == escape_ends[-1]
    # Any single block can be read by its own offsets.
    i = len(blocks) - 1
    w, e = (0 if i == 0 else word_ends[i - 1]), (0 if i == 0 else escape_ends[i - 1])
    own = simple8b.decode(words[w:], word_ends[i:] - w, np.array([len(blocks[i])]), escapes[e:])
    assert own.tolist() == blocks[i]


def test_words_are_as_dense_as_their_ids():
    for width, count in zip(simple8b.WIDTHS, simple8b.COUNTS):
        ids = np.full(count * 50, (1 << width) - 2)
        words, *_ = simple8b.encode(ids, [len(ids)])
        assert len(words) == 50
    mixed = np.where(np.arange(6000) % 60 == 7, 2**31, 0)  # an escape doesn't widen the slots beside it
    assert len(simple8b.encode(mixed, [6000])[0]) == 100


def expected_tokens(rows):
    whole = Tokenizer.from_file(token_files.tokenizer_path("word_bpe_49k.json"))
    out = []
    for i, t in rows:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, ids))
    return out


def check_files(got, rows):
    want = {}
    for i, ids in expected_tokens(rows):
        want.setdefault(i, []).append(np.array(ids, "<u4").tobytes())
    at = 0
    order = sorted(got, key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id or 0) for r in order] == sorted((i is not None, i or 0) for i, _ in rows)
    for r in order:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens
        want[r.doc_id].remove(bytes(r.ids))
        at += r.n_tokens
    assert not any(want.values())


def test_files_give_back_every_document(spark, tmp_path, monkeypatch):
    rows = AWKWARD + [(50 + n, f"text {n} " * n) for n in range(60)]
    path = str(tmp_path / "files")
    token_files.write_token_files(documents(spark, rows), path)
    check_files(token_files.read_token_files(spark, path).collect(), rows)
    index = json.loads((tmp_path / "files" / "index.json").read_text())
    assert sum(f["documents"] for f in index["files"]) == len(rows)
    # What a lost task left behind isn't listed, so it isn't read.
    (tmp_path / "files" / "part-000000-0000-lost.s8b").write_bytes(b"half a file")
    assert token_files.read_token_files(spark, path).count() == len(rows)


def test_empty_tables_give_an_index_alone(spark, tmp_path):
    token_files.write_token_files(documents(spark, []), str(tmp_path / "none"))
    assert token_files.read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_blocks_batches_and_rolling(monkeypatch):
    rng = random.Random(1)
    monkeypatch.setattr(token_files, "BLOCK", 16)
    monkeypatch.setattr(token_files, "BATCH_IDS", 50)
    docs = [np.array([rng.randrange(2 ** rng.choice([3, 15, 32])) for _ in range(rng.choice([1, 5, 16, 17, 90]))], "<u4").tobytes() for _ in range(80)]
    batch = token_files.coded([None, *range(79)], docs)
    data = token_files.file_bytes(list(zip(*(c.to_pylist() for c in batch.columns))))
    rows = [r for b in token_files.documents_of(data, 1000) for r in b.to_pylist()]
    assert [r["doc_id"] for r in rows] == [None, *range(79)]
    assert [zlib.crc32(r["ids"]) for r in rows] == list(map(zlib.crc32, docs))
    assert [r["start"] for r in rows] == [1000 + sum(len(d) // 4 for d in docs[:i]) for i in range(80)]
    with pytest.raises(ValueError, match="not a token file"):
        list(token_files.documents_of(b"something else", 0))
    written = {}
    monkeypatch.setattr(token_files, "FILE_IDS", 200)
    monkeypatch.setattr(token_files, "_put", lambda path, content: written.update({path: content}))
    monkeypatch.setattr(token_files.TaskContext, "get", classmethod(lambda cls: type("T", (), {"partitionId": lambda self: 3})()))
    message = token_files._Writer("base").write(iter([batch]))
    assert sum(n for _, n, _ in message.files) == 80 and len(message.files) > 5
    assert all(ids <= 200 or n == 1 for _, n, ids in message.files)


# --- vector codes ------------------------------------------------------------------------


def codes_plainly(rows, parts, entries, rounds):
    """``{(id, vector): (code, error)}`` and the codebooks, by comparing every part with every entry."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    points = [[int(np.floor(256 * x)) for x in v] for _, v in kept]
    width = len(points[0]) // parts
    order = sorted((i, v, p) for (i, v), p in zip(kept, points) if i is not None)[:entries]
    codes = [[] for _ in points]
    errors = [0] * len(points)
    books = []
    for part in range(parts):
        own = [p[part * width : (part + 1) * width] for p in points]
        book = [p[part * width : (part + 1) * width] for _, _, p in order]

        def nearest(x):
            return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

        for _ in range(rounds):
            groups = {}
            for x in own:
                groups.setdefault(nearest(x)[1], []).append(x)
            book = [[sum(c) // len(groups[e]) for c in zip(*groups[e])] if e in groups else c for e, c in enumerate(book)]
        for n, x in enumerate(own):
            d, e = nearest(x)
            codes[n].append(f"{e:02x}")
            errors[n] += d
        books += book
    return sorted(map(str, ((i, "".join(c), e) for (i, _), c, e in zip(kept, codes, errors)))), [x for b in books for x in b]


VECTORS = "vec_id bigint, embedding array<float>, label int, code string, error bigint, trees string, of int"


def vector_table(spark, rows):
    full = [(i, v, None if n % 5 == 0 else n % 3, "c", 1, "t", 2) for n, (i, v) in enumerate(rows)]
    return spark.createDataFrame(full, VECTORS)


def as_floats(v):
    return [float(x) for x in np.array(v, np.float32)]


@pytest.mark.parametrize(("kind", "entries"), [("spread", 8), ("copies", 16), ("tight", 5), ("few", 16)])
def test_codes_equal_brute_force(spark, kind, entries):
    rng = np.random.default_rng(len(kind))
    n = 9 if kind == "few" else 700
    data = rng.normal(size=(n, 8)) * (0.02 if kind == "tight" else 1)
    if kind == "copies":
        data[::2] = data[0]
    rows = [(1000 - i if i % 11 else 500, as_floats(v)) for i, v in enumerate(data)]
    rows += [(None, as_floats(data[1])), (1, None), (2, [None] * 8), (3, [float("nan")] * 8), (4, [float("inf")] * 8), (5, [1.0] * 7), (6, [])]
    whole = [r for r in rows if r[1] is None or len(r[1]) == 8]
    want, books = codes_plainly(whole, 4, entries, 2)
    codes, found = vector_codes.vector_codes(vector_table(spark, rows), parts=4, entries=entries, leaf=4)
    got = codes.collect()
    assert sorted(str((r.vec_id, r.code, r.error)) for r in got) == want
    assert found.ravel().tolist() == books
    totals = {}
    for r in got:
        totals[r.label] = totals.get(r.label, 0) + r.error
    summed = vector_codes.with_label_errors(codes).collect()
    assert len(summed) == len(got) and all(r.label_error == totals[r.label] for r in summed)


def test_balls_are_owned_without_their_points():
    rng = np.random.default_rng(5)
    centres = rng.integers(-5000, 5000, (12, 4))
    points = centres[rng.integers(0, 12, 6000)] + rng.integers(-20, 20, (6000, 4))
    tree = vector_codes.grown(points)
    whole, _, compared, _ = vector_codes.handed_down(tree, centres)
    assert (tree["end"][whole] - tree["start"][whole]).sum() + len(compared) == 6000
    assert len(compared) == 0 and len(whole) < 200
    assert np.array_equal(tree["sums"][0], points.sum(axis=0))


def test_codes_of_nothing_and_of_too_much(spark):
    codes, books = vector_codes.vector_codes(vector_table(spark, []))
    assert vector_codes.with_label_errors(codes).count() == 0 and books.size == 0
    with pytest.raises(Exception, match="no longer fit"):
        vector_codes.vector_codes(vector_table(spark, [(1, [1e30] * 16)]))


def test_blocks_of_any_size_give_the_same(spark):
    rng = np.random.default_rng(9)
    rows = [(i, as_floats(v)) for i, v in enumerate(rng.normal(size=(300, 16)))]
    want = sorted(vector_codes.vector_codes(vector_table(spark, rows))[0].collect())
    small = vector_codes.vector_codes(vector_table(spark, rows).repartition(3), block=17, leaf=3)[0]
    assert sorted(small.select("vec_id", "code", "error").collect()) == sorted(r[0:1] + r[2:] for r in want)
