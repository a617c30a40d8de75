"""The pipeline's stages, each on what its predecessor kept."""

import corpus_pipeline as pipeline
from feedlake.llm.store import settle
from rows import AWKWARD, documents, hit_words, linked_components

STAGES = dict(pipeline.STAGES)


def test_stages_take_effect(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r for r in docs.collect()}
    docs = settle(STAGES["language ID"](spark, docs, small), "s")
    kept = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and len(kept) >= 0.98 * len(before)

    docs = settle(STAGES["n-gram Jaccard join"](spark, docs, small), "s")
    groups = linked_components([(i, r.text) for i, r in kept.items()])
    kept = {r.doc_id: r for r in docs.collect()}
    assert docs.columns == columns and set(kept) == {top for _, top in groups.values()}

    docs = settle(STAGES["benchmark decontamination"](spark, docs, small), "s")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    clean = {i for i, r in kept.items() if not hit_words(r.text, items)[1]}
    assert docs.columns == columns and {r.doc_id for r in docs.collect()} == clean

    masked = settle(STAGES["PII"](spark, docs, small), "s")
    assert masked.columns == columns and masked.schema["n_chars"] == docs.schema["n_chars"]
    for r in masked.collect():
        assert r.n_chars == len(r.text) and (r.text == before[r.doc_id].text or "<" in r.text)

    packed = STAGES["best-fit packing"](spark, masked, small)
    assert {r.doc_id for r in packed.collect()} == clean


def test_stages_take_awkward_rows(spark, small):
    for texts in (AWKWARD, []):
        docs = documents(spark, texts)
        for name, stage in pipeline.STAGES:
            columns = docs.columns
            docs = settle(stage(spark, docs, small), "s")
            assert name == pipeline.STAGES[-1][0] or docs.columns == columns
        if texts:
            ids = [r.doc_id for r in docs.where("piece = 0").collect()]
            assert sorted(i for i in ids if i is not None) == [1, 6, 7]


def test_rows_of_one_id_are_judged_apart(spark, small):
    item = next(r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect() if len(r.text.split()) > 12)
    plain = [" ".join(f"{w}{n}" for n in range(40)) for w in ("some", "other", "third")]
    rows = [(1, plain[0]), (1, f"{plain[1]} {item}"), (None, f"{item} {plain[2]}"), (None, plain[2]), (3, plain[2]), (2, plain[2]), (2, "")]
    docs = documents(spark, rows)
    kept = settle(STAGES["benchmark decontamination"](spark, docs, small), "s")
    assert kept.columns == docs.columns
    assert {(r.doc_id, r.text) for r in kept.collect()} == {rows[0], *rows[3:]}
    kept = settle(STAGES["n-gram Jaccard join"](spark, docs, small), "s")
    assert {(r.doc_id, r.text) for r in kept.collect()} == {*rows[:3], rows[5], rows[6]}


def test_workers_give_back_memory_after_each_task_of_a_stage(spark, small, monkeypatch):
    from feedlake.llm import workers

    used, frame = [], type(spark.range(1))
    real = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda df, rows, *a, **k: used.append(rows) or real(df, rows, *a, **k))
    docs = documents(spark, AWKWARD)
    for _, stage in pipeline.STAGES:
        stage(spark, docs, small)
    assert len(used) >= 9 and all(rows.__code__ is workers.tidy(rows).__code__ for rows in used)

    given_back = []

    class Pool:
        def release_unused(self):
            given_back.append(len(seen))

    monkeypatch.setattr(workers.pa, "default_memory_pool", Pool)
    monkeypatch.setattr(workers.pa, "system_memory_pool", Pool)
    seen = []
    for batch in workers.tidy(lambda batches: (b + 1 for b in batches))(iter([1, 2])):
        seen.append(batch)
    assert seen == [2, 3] and given_back == [2, 2]


def test_stages_bound_batches_by_bytes_unless_the_session_does(spark, small):
    name, docs = "spark.sql.execution.arrow.maxBytesPerBatch", documents(spark, AWKWARD)
    before = spark.conf.get(name, None)
    try:
        for stage in ("language ID", "n-gram Jaccard join", "PII", "best-fit packing"):
            spark.conf.unset(name)
            STAGES[stage](spark, docs, small)
            assert 0 < int(spark.conf.get(name)) <= 1 << 20
        spark.conf.set(name, "5000")
        STAGES["PII"](spark, docs, small)
        assert spark.conf.get(name) == "5000"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
