from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.functions.hashing import coefficients, java_hash
from feedlake.operators import sketches
from feedlake.operators.similar import class_pairs, pair_count, similar_groups, similar_pairs

SCHEMA = "rid string, sch_tpl string, ts_tpl string, event_type string"
ONE = [("r", "PADTLL", "PADTLL", "arr")]
TWO = ONE + [("r", "PADTLL", "CLPHMJC", "dep")]
some = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@pytest.mark.parametrize(
    "rows,head",
    [
        (ONE, [516114735, 1001901160, 1076279069, 2139326272]),
        (TWO, [418461436, 1001901160, 1042146973, 1145475282]),
        (TWO + TWO, [418461436, 1001901160, 1042146973, 1145475282]),
    ],
)
def test_known_signatures(spark, rows, head):
    df = spark.createDataFrame(rows, SCHEMA)
    for build in (sketches.minhash_signature, sketches.minhash_running):
        signature = build(df, ["rid"]).first().minhash_signature
        assert len(signature) == 128 and signature[:4] == head


def test_large_group_goes_through_partial_signatures(spark):
    # more distinct hashes per slice than positions, in one hot group
    rows = spark.range(60_000).select(
        F.when(F.col("id") < 50_000, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("rid"),
        F.col("id").cast("string").alias("f"),
    )
    got = sketches.minhash_signature(rows, ["rid"], ["f"], length=16)
    want = sketches.minhash_running(rows, ["rid"], ["f"], length=16)
    assert sorted(got.collect()) == sorted(want.collect())


@some
@given(st.sets(st.integers(0, 50), min_size=1), st.sets(st.integers(0, 50), min_size=1))
def test_merge_is_union(spark, left, right):
    rows = [("l", str(x)) for x in left] + [("r", str(x)) for x in right]
    df = spark.createDataFrame(rows, "part string, f string")
    parts = sketches.minhash_signature(df, ["part"], ["f"]).withColumn("all", F.lit(1))
    merged = sketches.minhash_merge(parts, ["all"]).first().minhash_signature
    whole = sketches.minhash_signature(df.withColumn("all", F.lit(1)), ["all"], ["f"])
    assert merged == whole.first().minhash_signature


BLOOM_ONE = "AAAAAAAAAEAAAAAAAAAAAAAAAACAAAAAAAAAAAAAAAAAAAAAAEAAAAAAAAAAAAAAAAAAACAAQAIB"
BLOOM_TWO = "AAAAAACAAEAAAAAAAAAgAAAAAACAAAAAAAAAAAQAAAAAAAAAAEAAAAAQAAAAAAAAAAAAACAAQAIBACAEAEA="


@pytest.mark.parametrize(
    "locations,text",
    [([None], ""), (["PADTLL"], BLOOM_ONE), (["PADTLL", None, "CLPHMJC"], BLOOM_TWO)],
)
def test_known_filters(spark, locations, text):
    df = spark.createDataFrame([("r", x) for x in locations], "rid string, ts_tpl string")
    assert sketches.bloom_filter(df, ["rid"]).first().bloom_filter_base64 == text


def test_bloom_merge_and_membership(spark):
    df = spark.createDataFrame([(1, "PADTLL"), (2, "CLPHMJC"), (3, None)], "part int, ts_tpl string")
    parts = sketches.bloom_filter(df, ["part"]).withColumn("all", F.lit(1))
    merged = sketches.bloom_merge(parts, ["all"])
    assert merged.first().bloom_filter_base64 == BLOOM_TWO
    has = lambda e: sketches.might_contain(F.col("bloom_filter_base64"), F.lit(e))
    row = merged.select(has("PADTLL").alias("p"), has("CLPHMJC").alias("c"), has("EUSTON").alias("e")).first()
    assert (row.p, row.c, row.e) == (True, True, False)
    empty = parts.filter("part = 3").select(has("PADTLL").alias("p")).first()
    assert empty.p is False


@some
@given(st.sets(st.text("ABCDEFGHIJ", min_size=1, max_size=7), min_size=1, max_size=40))
def test_no_false_negatives(spark, locations):
    df = spark.createDataFrame([("r", x) for x in locations], "rid string, ts_tpl string")
    probed = df.join(sketches.bloom_filter(df, ["rid"]), "rid")
    inside = sketches.might_contain(F.col("bloom_filter_base64"), F.col("ts_tpl"))
    assert probed.filter(~inside).count() == 0


# --- similar pairs -----------------------------------------------------------------


def _brute(rows, threshold):
    out = []
    for w1, r1, s1 in rows:
        for w2, r2, s2 in rows:
            if w1 == w2 and r1 < r2 and s1 and s2 and len(s1) == len(s2):
                equal = sum(a is not None and a == b for a, b in zip(s1, s2))
                if equal / len(s1) >= threshold:
                    out.append((w1, r1, r2, equal / len(s1)))
    return sorted(out)


def _found(spark, rows, threshold, **options):
    df = spark.createDataFrame(
        [(r, w, s) for w, r, s in rows], "rid string, window_end string, minhash_signature array<bigint>"
    )
    return sorted(tuple(r) for r in similar_pairs(df, threshold, **options).collect())


signature = st.lists(st.one_of(st.integers(0, 3), st.none()), min_size=8, max_size=8)


@some
@given(
    st.lists(st.tuples(st.sampled_from("uvw"), signature), min_size=2, max_size=25),
    st.sampled_from([0.1, 0.3, 0.5, 1.0]),
    st.sampled_from([1, 2, 4096]),
)
def test_pairs_equal_brute_force(spark, drawn, threshold, slice_rows):
    rows = [(w, f"j{i:02d}", s) for i, (w, s) in enumerate(drawn)]
    assert _found(spark, rows, threshold, slice_rows=slice_rows) == _brute(rows, threshold)


def test_pairs_of_copies_and_hot_tokens(spark):
    # a third of the journeys are copies; another third share hot values but little else
    n, size = 90, 16
    rows = []
    for i in range(n):
        if i % 3 == 0:
            s = list(range(size))
        elif i % 3 == 1:
            s = [7] * 3 + [1000 + i * size + k for k in range(size - 3)]
        else:
            s = [i % 5] * size
        rows.append(("w", f"j{i:03d}", s))
    for slice_rows in (3, 10, 4096):
        for threshold in (0.1, 0.25):
            assert _found(spark, rows, threshold, slice_rows=slice_rows) == _brute(rows, threshold)


def test_groups_stand_for_the_same_pairs(spark):
    rows = [("w", f"j{i:02d}", [i % 3, 5, None, i % 4]) for i in range(24)] + [("v", "x", [0, 5, None, 0])]
    df = spark.createDataFrame(
        [(r, w, s) for w, r, s in rows], "rid string, window_end string, minhash_signature array<bigint>"
    )
    journeys, pairs = similar_groups(df, 0.5)
    assert journeys.count() == 25 and journeys.select("id1", "id2").distinct().count() == 13
    got = pairs.groupBy("window_end", "similarity").agg(F.sum(pair_count()).alias("n")).collect()
    want = Counter((w, s) for w, _, _, s in _brute(rows, 0.5))
    assert {(r.window_end, r.similarity): r.n for r in got} == want


def _classed(rows, threshold):
    """Pairs of the least journeys of equal signatures, and of those with their copies."""
    named = {}
    for w, r, s in sorted(rows, key=lambda row: row[1]):
        named.setdefault((w, tuple(s)), r)
    first = {(w, r) for (w, _), r in named.items()}
    name = {(w, r): named[w, tuple(s)] for w, r, s in rows}
    return [
        (w, a, b, s) for w, a, b, s in _brute(rows, threshold)
        if ((w, a) in first and (w, b) in first) or name[w, a] == name[w, b] == a
    ]


@some
@given(
    st.lists(st.tuples(st.sampled_from("uv"), signature), min_size=2, max_size=25),
    st.sampled_from([0.1, 0.5, 1.0]),
    st.sampled_from([1, 4096]),
)
def test_class_pairs_equal_brute_force(spark, drawn, threshold, slice_rows):
    rows = [(w, f"j{(i * 7) % 25:02d}", s) for i, (w, s) in enumerate(drawn)]
    df = spark.createDataFrame([(r, w, s) for w, r, s in rows], "rid string, window_end string, minhash_signature array<bigint>")
    got = sorted(map(tuple, class_pairs(df, threshold, slice_rows).collect()))
    assert got == sorted(_classed(rows, threshold))


def test_copies_cost_a_row_each(spark):
    rows = [("w", f"j{k:04d}", [k % 2, 5, 6, 7]) for k in range(600)]
    df = spark.createDataFrame([(r, w, s) for w, r, s in rows], "rid string, window_end string, minhash_signature array<bigint>")
    got = [tuple(r) for r in class_pairs(df, 0.5).collect()]
    assert len(got) == 599 and ("w", "j0000", "j0001", 0.75) in got


def test_pairs_with_scratch_folder(spark, tmp_path):
    rows = [("w", f"j{i}", [i % 2, 5, i, 6]) for i in range(12)]
    assert _found(spark, rows, 0.5, scratch=str(tmp_path)) == _brute(rows, 0.5)


def test_signatures_of_different_length_never_pair(spark):
    rows = [("w", "a", [1, 2, 3]), ("w", "b", [1, 2]), ("w", "c", [1, 2, 3]), ("w", "d", []), ("w", "e", None)]
    assert _found(spark, rows, 0.1) == [("w", "a", "c", 1.0)]
    with pytest.raises(ValueError):
        _found(spark, rows, 0)


def test_estimate_is_near_true_similarity(spark):
    left, right = set(range(0, 60)), set(range(30, 90))
    rows = [("l", str(x)) for x in left] + [("r", str(x)) for x in right]
    df = spark.createDataFrame(rows, "rid string, f string")
    sig = sketches.minhash_signature(df, ["rid"], ["f"]).withColumn("window_end", F.lit("w"))
    (pair,) = similar_pairs(sig).collect()
    assert abs(pair.similarity - 30 / 90) < 4 * (1 / 3 * 2 / 3 / 128) ** 0.5


def test_hash_family_matches_direct_computation(spark):
    h = spark.range(1).select(java_hash(F.lit("x"))).first()[0]
    want = [(a * h + b) % (2**31 - 1) for a, b in coefficients(128, 42)]
    df = spark.createDataFrame([("r", "x")], "rid string, f string")
    assert sketches.minhash_signature(df, ["rid"], ["f"]).first().minhash_signature == want
