"""Jaccard components, decontamination, personal data, toxicity, languages and passages against plain versions."""

import hashlib
import random

import pytest
from compare import difference
from feedlake.llm import decontam, jaccard, langid, neighbours, passages, pii, queries, shingles, toxicity
from feedlake.llm.components import components
from pyspark.sql import functions as F
from rows import AWKWARD, base_spans, documents, hit_words, linked_components


def read(spark, small, name="documents"):
    return spark.read.parquet(f"{small}/{name}.parquet")


# --- Jaccard ---------------------------------------------------------------------


def altered(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return words


def test_components_equal_those_of_all_pairs(spark):
    rng, rows = random.Random(7), []
    common = [f"shared{n}" for n in range(12)]
    for size in (3, 5, 6, 9, 14, 30, 63, 64, 65, 130, 300):
        base = [f"w{size}x{n}" for n in range(size)]
        for changes in (0, 0, 1, 1, 2, size // 30 + 1, size // 25 + 2):
            rows.append(altered(rng, base, changes))
        rows.append(base + ["one", "more", "word"])
        drift = base
        for _ in range(6):  # a path of near copies whose ends differ
            drift = altered(rng, drift, max(1, size // 60))
            rows.append(drift)
        rows += [common + altered(rng, base, size // 2), common + altered(rng, base, size)]
    rows = [(n * 3, " ".join(w)) for n, w in enumerate(rows)]
    rng.shuffle(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(documents(spark, rows)).collect()}
    assert got == linked_components(rows)


def test_components_of_documents(spark, small):
    rows = [(r.doc_id, r.text) for r in read(spark, small).collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op6_jaccard_components(spark, small).collect()}
    assert got == linked_components(rows)


def test_components_of_awkward_rows(spark):
    rows = jaccard.jaccard_components(documents(spark, AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    got = sorted((r.doc_id, r.component_id) for r in rows if r.doc_id is not None)
    assert got == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 1), (5, 1), (6, 6), (7, 7)]
    assert [r.component_id for r in rows if r.doc_id is None] == [None]
    assert jaccard.jaccard_components(documents(spark, [])).count() == 0


def test_sets_with_many_common_keys_make_one_pair(spark):
    held = {n: {f for f in range(60) if (f * 7 + n) % 5} for n in range(12)} | {12: {1000, *range(60, 80)}, 13: {1000, *range(80, 100)}}
    rows = [(key, n, n, n, 300, *[0] * 4, n, [0] * 16) for n, keys in held.items() for key in keys]
    schema = "key bigint, f1 bigint, f2 bigint, node bigint, n bigint, b0 bigint, b1 bigint, b2 bigint, b3 bigint, component bigint, middle array<bigint>"
    apart = jaccard._with_least_keys(spark.createDataFrame(rows, schema))
    got = sorted((r.anode, r.bnode) for r in jaccard._all_between(apart).collect())
    # The last two carry no key in common, but still meet on the one they have.
    assert got == sorted((a, b) for a in held for b in held if a < b and held[a] & held[b])
    assert (12, 13) in got and len(got) == 12 * 11 // 2 + 1


def test_last_join_makes_no_row_for_sets_that_the_middle_sketch_tells_apart(spark):
    # Alike in the narrow sketch; the middle ones differ in 70 bits for every other node, where 600 members allow 66.
    rows = [(1, n, n, n, 300, *[0] * 4, n, [(1 << 35) - 1] * 2 * (n % 2) + [0] * (16 - 2 * (n % 2))) for n in range(6)]
    schema = "key bigint, f1 bigint, f2 bigint, node bigint, n bigint, b0 bigint, b1 bigint, b2 bigint, b3 bigint, component bigint, middle array<bigint>"
    pairs = jaccard._all_between(jaccard._with_least_keys(spark.createDataFrame(rows, schema)))
    assert sorted((r.anode, r.bnode) for r in pairs.collect()) == [(a, b) for a in range(6) for b in range(a + 1, 6) if (b - a) % 2 == 0]
    # Nothing is left to be thrown away above the join.
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan.partition("Join Inner")[0] and "Join Inner" in plan


def test_wide_sketches_reach_the_middle_one(spark):
    rows = jaccard.set_sizes(spark.createDataFrame([(1, "a b c d e f g"), (2, None), (3, " ".join(map(str, range(3000))))], "doc_id bigint, text string"))
    assert {r.doc_id: len(r.wide) for r in rows.collect()} == {1: jaccard.MIDDLE, 2: jaccard.MIDDLE, 3: 128}


def test_enough_segments_are_filled():
    import numpy as np

    rng = np.random.default_rng(1)
    for n in (4, 7, 8, 15, 31, 200, 1023, 1024):
        members = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
        assert len(jaccard.sketch_keys(members)) >= (n + min(2 * n, n * 5 // 4)) // 9 * (n > 3)


def test_path_and_hub_components(spark):
    edges = [(n, n + 1) for n in range(40)] + [(100, n) for n in range(101, 140)] + [(7, 7), (101, 100)]
    got = dict(components(spark.createDataFrame(edges, "u bigint, v bigint")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 140), 100)}


# --- benchmark -------------------------------------------------------------------

ITEMS = [
    (1, "One two three four five six seven eight nine ten eleven twelve thirteen"),
    (10, "one two THREE four five six seven eight nine ten, eleven"),
    (2, "just four words here"),
    (3, "É"),
    (4, None),
    (5, "..."),
    (None, "nobody knows this id at all but it has enough words for a window"),
    (2, "just four words here"),
]


def test_hits_equal_those_of_every_window(spark):
    texts = [
        (1, "x one two three four five six seven eight nine ten eleven twelve y"),
        (2, "one two three four five six seven eight nine"),
        (3, "Just! four; words here just four words here, É"),
        (4, "é"),
        (5, "as nobody knows this id at all but it has enough words for a window"),
        (6, "one two three four five six seven eight nine ten one two three four five six seven eight nine ten eleven"),
        *[(i + 20, t) for i, t in enumerate(t for _, t in AWKWARD)],
        (None, "just four words here"),
    ]
    items = spark.createDataFrame([(i, t, "k") for i, t in ITEMS], "item_id bigint, text string, key string")
    got = {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontam.decontaminate(documents(spark, texts), items).collect()}
    want = set()
    for i, t in texts:
        n, hit, _ = hit_words(t, ITEMS)
        ids = hit_words(t, [x for x in ITEMS if x[0] is not None])[2]
        want.add((i, n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0))
    assert got == want
    empty = items.limit(0)
    assert not any(r.contaminated for r in decontam.decontaminate(documents(spark, texts), empty).collect())
    assert decontam.decontaminate(documents(spark, []), items).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_rows_equal_their_sql(spark, small, name):
    assert difference(spark, queries.QUERIES[name], queries.ORACLES[name], small) is None


def test_no_python_on_the_way(spark, small):
    out = decontam.decontaminate(read(spark, small), read(spark, small, "benchmark"))
    assert not any(w in out._jdf.queryExecution().toString() for w in ("Python", "Pandas", "Arrow"))


# --- personal data ---------------------------------------------------------------


def test_base_spans_equal_their_patterns():
    rng = random.Random(3)
    parts = ["a", "b.c", "@", "@", "1", "255", "256", ".", ".", "-", " ", "+", "4111111111111111", "(", "_", "é", "٣", "\n", "12", "0", "%"]
    for _ in range(40_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 16)))
        assert pii.base_spans(text) == base_spans(text), text
    assert pii.base_spans("1" * 100_000 + "a" * 100_000 + "@") == []


def test_spans_of_documents(spark, small):
    texts = {r.doc_id: r.text or "" for r in read(spark, small).collect()}
    rows = queries.op9_pii_spans(spark, small).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = base_spans(texts[r.doc_id])
        listed = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in base) for n in range(4)]
        assert set(listed) <= set(r.spans.split(",")) | {""}


def test_method_adds_spans_and_masks(spark):
    known = [(200 + n, f"call me on the phone +1 (202) 555-{1000 + n} or mail a{n}@host.com") for n in range(40)]
    found = [(100 + n, f"my mobile phone is 202 555 {1000 + n} so call, version 2024-01-{10 + n}") for n in range(10)]
    docs = documents(spark, known + found + AWKWARD)
    spans = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    assert len(spans) == len({i for i, _ in known + found + AWKWARD})
    assert all(spans[100 + n] == "phone:19:31" for n in range(10))
    masked = pii.mask_pii(docs)
    assert masked.schema.names == docs.schema.names
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert texts[200] == "call me on the phone <PHONE> or mail <EMAIL>"
    assert texts[100] == "my mobile phone is <PHONE> so call, version 2024-01-10"
    assert texts[2] is None and texts[3] == "" and texts[6] == dict(AWKWARD)[6]
    assert pii.find_pii(documents(spark, [])).count() == 0


def test_parts_of_failed_matches_and_other_numbers(spark):
    """Numbers that the base patterns swallow are added; keys, versions and numbers that fail their check aren't."""
    card, other, wrong = "4111111111111111", "5500 0000 0000 0004", "4111111111111112"
    known = [(n, f"x +1 (202) 555-{1000 + n} and {card} with 10.0.{n}.7 or a{n}@host.com") for n in range(60)]
    noise = [(100 + n, f"token {n:02d}ab{7654321 + n}cd under CC 4.0 at @someone {int(wrong) + 10 * n * (n % 2)}") for n in range(60)]
    noise = [(i, t) for i, t in noise if not pii.base_spans(t)]
    cases = [
        (300, "de +1 (826) 555-4081 190.137.223.204 du", "ip:21:36,phone:3:20"),
        (301, f"a {card} {other} b", "card:2:18,card:19:38"),
        (302, f"a {wrong} {card} b", "card:19:35"),
        (303, f"a {wrong} b", ""),
        (304, "+" + "1" * 40, ""),
    ]
    docs = documents(spark, known + noise + [c[:2] for c in cases])
    spans = {r.doc_id: r.spans for r in pii.find_pii(docs).collect()}
    assert {i: spans[i] for i, _, _ in cases} == {i: want for i, _, want in cases}
    assert len(noise) > 30 and all(spans[i] == "" for i, _ in noise)
    assert all(not set(spans[i].split(",")) ^ {f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(t)} for i, t in known)


def test_taken_stretches():
    rng = random.Random(8)
    for _ in range(300):
        spans = [(a, a + rng.randint(1, 6)) for a in rng.sample(range(40), 6)]
        taken = pii._Taken(spans[:3])
        taken.add(spans[3:])
        for a in range(45):
            b = a + rng.randint(1, 5)
            assert taken.free(a, b) == all(b <= x or y <= a for x, y in spans)
    text = "a 4111111111111111 " * 20_000 + "+" * 1000 + "12345 " * 20_000
    assert len(pii.candidates(text, pii.base_spans(text))) >= 20_000


def test_masking_sends_the_text_once_and_works_in_slices(spark, monkeypatch):
    import pyarrow as pa

    docs, sent, real = documents(spark, [(n, f"write to a{n}@host.com") for n in range(5)]), [], pii.candidate_spans
    monkeypatch.setattr(pii, "candidate_spans", lambda rows, *keep: sent.append(rows.schema) or real(rows, *keep))
    masked = pii.mask_pii(docs)
    assert masked.columns == docs.columns and {r.text for r in masked.collect()} == {"write to <EMAIL>"}
    assert sent[0].names == ["row", "text"] and len(sent[0]["row"].dataType.names) == len(docs.columns)  # none of them the text
    only = pii.mask_pii(docs.select(F.col("text").alias("a.b")), "a.b")
    assert only.columns == ["a.b"] and {r[0] for r in only.collect()} == {"write to <EMAIL>"}
    spans = pa.array([[{"kind": 0, "start": 0, "end": 1, "base": True, "pattern": 0}]] * 1000, pa.list_(pii.SPAN))
    batch = pa.record_batch([pa.array([{"none": 0}] * 1000), pa.array(["ab"] * 1000), spans], ["row", "text", "spans"])
    made = list(pii.mask_batches(iter([batch])))
    assert max(b.num_rows for b in made) <= pii.SLICE and [t for b in made for t in b.column("text").to_pylist()] == ["<EMAIL>b"] * 1000


def test_overlapping_spans_are_masked_once():
    spans = [{"kind": 2, "start": 2, "end": 8}, {"kind": 3, "start": 0, "end": 5}]
    assert pii.masked("0123456789", spans) == "<PHONE>89"


# --- toxicity --------------------------------------------------------------------


def test_toxicity_on_held_out_rows(spark):
    words = [f"{a}{b}" for a in ("tra", "mon", "bel", "sor", "kin", "dul") for b in ("te", "lo", "ra", "nis", "met", "von", "gar")]
    rng, rows, labels = random.Random(5), [], []
    for i in range(1200):
        text = [rng.choice(words) for _ in range(rng.randint(5, 60))]
        toxic = i % 5 == 0
        if toxic:
            text[rng.randrange(len(text))] = "idi" + rng.choice(["ot", "otic", "ots"])
        rows.append((i, " ".join(text)))
        labels.append((i, 0, int(toxic)))
    rows += [(5000 + n, t) for n, (_, t) in enumerate(AWKWARD)] + [(None, None)]
    table = spark.createDataFrame([*labels, (None, None, None), (3, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = toxicity.score_toxicity(documents(spark, rows), table).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 1200]
    import zlib

    assert {r.doc_id for r in held} == {i for i in range(1200) if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.predicted == (r.doc_id % 5 == 0) for r in held) >= 0.97 * len(held)
    nothing = toxicity.score_toxicity(documents(spark, AWKWARD), table.limit(0)).collect()
    assert len(nothing) == len(AWKWARD) and not any(r.predicted for r in nothing)


def test_every_toxic_letter_group_keeps_its_ratio(spark):
    grams = spark.range(6000).selectExpr("lpad(id, 6, 'x') AS gram", "1 + id % 3 AS toxic", "id % 2 AS ordinary")
    contexts = grams.selectExpr("left(gram, 5)").distinct().count()
    assert toxicity.ratios(grams).select("piece").distinct().count() == 6000 + contexts


def test_a_table_too_long_to_broadcast_gives_the_same_scores(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["idiot", "tree", "house", "idiotic", "été", "i", "stone"]) for _ in range(9))) for i in range(200)]
    rows += [(500 + n, t) for n, (_, t) in enumerate(AWKWARD)] + [(None, None), (3, rows[3][1])]
    table = spark.createDataFrame([(i, int("idiot" in t)) for i, t in rows[:200]], "doc_id bigint, toxic int")
    by_id = lambda: sorted((str(r.doc_id), round(r.score, 9), round(r.strongest, 9)) for r in toxicity.score_toxicity(documents(spark, rows), table).collect())
    want = by_id()
    monkeypatch.setattr(toxicity, "PIECES", 3)
    assert by_id() == want and len(want) == len(rows)


def test_all_labels_but_those_of_the_curve_are_counted(spark, monkeypatch):
    counted, count = [], toxicity.word_counts
    monkeypatch.setattr(toxicity, "word_counts", lambda rows: counted.append(rows.count()) or count(rows))
    monkeypatch.setattr(toxicity, "CALIBRATION_ROWS", 5)
    rows = [(i, f"some words {i % 7} of a text") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 7 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    learned = labels.where(~toxicity.held_out(F.col("doc_id"))).count()
    toxicity.score_toxicity(documents(spark, rows), labels)
    assert counted == [learned - 5]


# --- languages -------------------------------------------------------------------


def test_languages_of_documents_and_pages(spark, small):
    rows = langid.identify_documents(read(spark, small)).collect()
    assert sum(r.language == r.declared and r.accepted for r in rows) >= 0.98 * len(rows)
    rows = queries.page_languages(spark, small).collect()
    assert len(rows) == read(spark, small, "pages").count() and all(r.accepted for r in rows)


def test_declared_language_is_overruled_by_text(spark, small):
    docs = read(spark, small)
    wrong = docs.withColumn("lang", F.when(F.col("doc_id") % 20 == 0, "fr").otherwise(F.col("lang")))
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = {r.doc_id: r.language for r in langid.identify_documents(wrong).collect()}
    assert sum(got[i] == truth[i] for i in truth) >= 0.97 * len(truth)


def test_languages_of_awkward_rows(spark):
    rows = langid.identify_documents(documents(spark, AWKWARD)).collect()
    assert len(rows) == len(AWKWARD)
    assert {r.doc_id for r in rows if not r.accepted} == {2, 3, 4}
    assert langid.identify_documents(documents(spark, [])).count() == 0
    nobody = documents(spark, AWKWARD).withColumn("lang", F.lit(None).cast("string"))
    assert not any(r.accepted for r in langid.identify_documents(nobody).collect())


def test_markup_language_is_found_wherever_the_tag_stands(spark):
    pages = [
        ("<!-- " + "x " * 5000 + "<html lang=fr> --><!DOCTYPE html>" + " " * 3000 + "<HTML class='a' lang='de-AT'>text", "de"),
        ("<!DOCTYPE html><html lang=en><p>", "en"),
        ("<html><p lang=es>", ""),
        ("<!-- <html lang=en>" + "y" * 50_000, ""),
        (None, ""),
    ]
    df = spark.createDataFrame([(n, h) for n, (h, _) in enumerate(pages)], "n int, html string")
    got = dict(df.select("n", langid.markup_language(F.col("html"))).collect())
    assert got == {n: want for n, (_, want) in enumerate(pages)}


# --- passages --------------------------------------------------------------------


def test_passages_exact_and_fuzzy(spark):
    rng = random.Random(9)
    own = lambda n: [f"own{rng.randrange(10**9)}" for _ in range(n)]
    exact, fuzzy = own(60), own(80)
    changed = list(fuzzy)
    changed[30] = "other"
    del changed[50]
    rows = [
        (1, own(100) + exact + own(20)),
        (2, exact + own(300)),
        (3, own(50) + exact),
        (4, own(30) + fuzzy + own(30)),
        (5, own(10) + changed + own(200)),
        (6, own(200)),
        (7, own(40) + exact[:30] + own(40)),
    ]
    copy = own(70)
    rows = [(i, " ".join(w)) for i, w in [*rows, (8, copy), (9, copy), (10, copy)]] + [(n + 50, t) for n, (_, t) in enumerate(AWKWARD)]
    got = passages.shared_passages(documents(spark, rows + [(None, rows[0][1])])).collect()
    spans = {(r.doc_id, r.other_id): (r.start, r.end) for r in got}
    assert {i for i, _ in spans} == {1, 2, 3, 4, 5, 8, 9, 10}
    assert spans[1, 2] == (100, 160) and spans[2, 1] == (0, 60) and (3, 1) in spans
    assert spans[4, 5][0] <= 31 and spans[4, 5][1] >= 109
    assert {(8, 9), (9, 8), (10, 8)} <= set(spans)
    assert passages.shared_passages(documents(spark, [])).count() == 0


def test_passages_with_other_words_between_are_both_found(spark):
    rng, rows, want = random.Random(21), [], {}
    own = lambda n: [f"own{rng.randrange(10**9)}" for _ in range(n)]
    for n, (length, between) in enumerate([(60, 35), (60, 50), (60, 70), (100, 70), (100, 120), (60, 5)]):
        head, foot = own(length), own(length)
        rows += [(2 * n, head + own(between) + foot), (2 * n + 1, own(9) + head + own(between) + foot)]
        want[2 * n] = {(0, length), (length + between, 2 * length + between)} if between > 5 else {(0, 2 * length + between)}
    got = {}
    for r in passages.shared_passages(documents(spark, [(i, " ".join(w)) for i, w in rows])).where("doc_id % 2 = 0").collect():
        assert r.alike >= passages.ALIKE and (r.other_start, r.other_end) == (r.start + 9, r.end + 9)
        got.setdefault(r.doc_id, set()).add((r.start, r.end))
    assert got == want


def test_stretches_cover_all_that_are_alike():
    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(60):
        same = np.concatenate([rng.random(n) < p for n, p in zip(rng.integers(5, 120, 5), rng.choice([0.05, 0.7, 0.8, 0.9, 1], 5))])
        in_a, in_b = same | (rng.random(len(same)) < 0.9), np.ones(len(same), bool)
        equal, words = np.r_[0, same.cumsum()], np.r_[0, in_a.cumsum()]
        fits = lambda i, j: words[j] - words[i] >= passages.LEAST and 5 * (equal[j] - equal[i]) >= 4 * (j - i)
        got = list(passages.stretches(same, in_a, in_b))
        assert all(fits(i, j) and same[i] and same[j - 1] for i, j in got)
        held = {k for i, j in got for k in range(i, j)}
        want = [(i, j) for i in range(len(same)) for j in range(i + 1, len(same) + 1) if same[i] and same[j - 1] and fits(i, j)]
        assert held == {k for i, j in want for k in range(i, j)}


def test_passage_shared_by_many_stays_linear(spark):
    rng = random.Random(2)
    common = " ".join(f"c{n}" for n in range(55))
    rows = [(n, " ".join(f"w{rng.randrange(10**9)}" for _ in range(rng.randint(0, 30))) + " " + common) for n in range(400)]
    got = passages.shared_passages(documents(spark, rows)).select("doc_id", "other_id").collect()
    assert {r.doc_id for r in got} == set(range(400))
    assert len(got) <= 4 * 400


# --- vectors ---------------------------------------------------------------------


def test_recall_and_order(spark):
    import numpy as np

    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(1500, 24)) * rng.uniform(0.5, 2, (1500, 1))
    rows = [(int(n), [float(x) for x in v]) for n, v in enumerate(vectors)]
    rows += [(2000 + n, rows[40][1]) for n in range(60)]  # copies
    bad = [(3000, None), (3020, []), (3040, [0.0] * 24), (3060, [float("nan")] + [1.0] * 23), (3080, [None] + [1.0] * 23), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v, "k") for i, v in rows + bad], "vec_id bigint, embedding array<double>, block string")
    got = {}
    for r in neighbours.nearest(df).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ids, table = np.array([i for i, _ in rows]), np.array([v for _, v in rows])
    assert set(got) == {i for i, _ in rows if i % 20 == 0}
    shares = []
    for query, found in got.items():
        scores = table @ table[np.flatnonzero(ids == query)[0]]
        order = [i for i in np.lexsort((ids, -np.round(scores, 9))) if ids[i] != query][:20]
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and query not in {f[1] for f in found}
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        shares.append(len({f[1] for f in found} & set(ids[order].tolist())) / 20)
    assert sum(shares) / len(shares) >= 0.9
    assert neighbours.nearest(df.limit(0)).count() == 0
    few = neighbours.nearest(df.where("vec_id in (0, 1, 2, 3080)")).collect()
    assert sorted(r.vec_id for r in few) == [1, 2]


def test_hilbert_steps_are_neighbours():
    import numpy as np

    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        keys = neighbours.hilbert(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert set(np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1).tolist()) == {1}


def test_word_hashes_tell_words_apart():
    import pyarrow as pa

    texts = ["a b", "A\tB", "ab", "", None, "a b c d e f", " a  b c d e F "]
    own = [s.tolist() for s in shingles.sets(pa.array(texts))]
    assert own[0] == own[1] and own[5] == own[6] and len(own[5]) == 2
    assert own[3] == own[4] == [] and own[2] != own[0]


CONTRACT = {
    "op1_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op3_extract_text": ["page_id", "url", "text", "n_chars"],
    "op4_nearest": ["query_id", "rank", "vec_id", "score"],
    "op6_jaccard_components": ["doc_id", "n_shingles", "component_id"],
    "op7_pack_sequences": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op8_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op9_pii_spans": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op10_token_counts": ["doc_id", "n_bytes", "n_tokens", "over_limit"],
}


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_queries_have_the_columns_of_the_contract(spark, small, name):
    out = queries.QUERIES[name](spark, small)
    assert out.columns[: len(CONTRACT[name])] == CONTRACT[name]
    assert out.count() > 0
