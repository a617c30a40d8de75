import math
import zlib
import gzip

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedlake.functions import noise
from feedlake.functions.expressions import dated, estimated_jaccard, feature_string, flag
from feedlake.functions.hashing import coefficients, java_hash
from feedlake.functions.payload import as_text, inflate, inflate_any, preview
from feedlake.functions.sqlnames import register_sql_functions

# Coefficient pairs and hashes known from the JDK's generator and string hash.
PAIRS_42 = {
    0: (1562431131, 117392763),
    1: (1467211249, 102948884),
    2: (662969971, 2023087525),
    3: (595021506, 1519796918),
    127: (776252254, 430738095),
}
PAIRS_123 = (
    (1553004783, 509477450),
    (2127939177, 647624789),
    (543942796, 1232933657),
    (1307388835, 555943837),
    (1730591586, 1336528453),
    (1879934640, 1179609726),
    (1537702473, 348355565),
)
HASHES = {
    "PADTLL": -1942497407,
    "CLPHMJC": 1585122949,
    "PADTLL|PADTLL|arr": 576633537,
    "NULL|NULL|NULL": -1159116121,
    "null|null|none": -1309459368,
    "Zürich": -1482116162,
    "": 0,
}

some = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_coefficients():
    pairs = coefficients(128, 42)
    assert {i: pairs[i] for i in PAIRS_42} == PAIRS_42
    assert coefficients(7, 123) == PAIRS_123
    with pytest.raises(ValueError):
        coefficients(0, 1)


def test_known_hashes(spark):
    rows = spark.createDataFrame([(k,) for k in HASHES], "s string").select("s", java_hash(F.col("s")).alias("h"))
    assert {r.s: r.h for r in rows.collect()} == HASHES
    assert _one(spark, java_hash(F.lit(None).cast("string"))) == 0


def _utf16_hash(text: str) -> int:
    units = text.encode("utf-16-be", "surrogatepass")
    h = 0
    for i in range(0, len(units), 2):
        h = (h * 31 + int.from_bytes(units[i : i + 2], "big")) % 2**32
    return h - 2**32 if h >= 2**31 else h


@some
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="\x00"), max_size=12), min_size=1, max_size=20))
def test_hash_of_any_text(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "s string").select("s", java_hash(F.col("s")).alias("h"))
    assert all(r.h == _utf16_hash(r.s) for r in rows.collect())


def test_feature_string(spark):
    assert _one(spark, feature_string(F.lit("A"), F.lit(None), F.lit(3))) == "A|NULL|3"


def test_dated_and_flag(spark):
    assert _one(spark, dated(F.lit("2025-01-01"), F.lit("10:00"))) == "2025-01-01T10:00"
    assert _one(spark, dated(F.lit(None).cast("string"), F.lit("10:00"))) is None
    assert _one(spark, dated(F.lit("2025-01-01"), F.lit(""))) is None
    assert [_one(spark, flag(F.lit(t), True)) for t in ("true", "0", "maybe")] == [True, False, True]


@pytest.mark.parametrize(
    "left,right,expected",
    [
        ([1, 2, 3, 4], [1, 2, 9, 9], 0.5),
        ([1, 2], [1, 2], 1.0),
        ([1, 2], [1], 0.0),
        ([], [], 0.0),
        (None, [1], 0.0),
        ([1], None, 0.0),
        ([1, None], [1, None], 0.5),
    ],
)
def test_estimated_jaccard(spark, left, right, expected):
    df = spark.createDataFrame([(left, right)], "l array<bigint>, r array<bigint>")
    assert df.select(estimated_jaccard(F.col("l"), F.col("r"))).first()[0] == expected
    register_sql_functions(spark)
    df.createOrReplaceTempView("pair")
    assert spark.sql("SELECT CalculateSimilarity(l, r) FROM pair").first()[0] == expected


def test_sql_names_agree_with_operators(spark):
    from feedlake.operators import sketches

    register_sql_functions(spark)
    rows = [("r", "PADTLL", "PADTLL", "arr"), ("r", "PADTLL", "CLPHMJC", "dep"), ("q", None, None, None)]
    df = spark.createDataFrame(rows, "rid string, sch_tpl string, ts_tpl string, event_type string")
    df.createOrReplaceTempView("joined")
    sql = spark.sql(
        "SELECT rid, MINHASH_SIGNATURE(collect_set(FEATURE_HASH(sch_tpl, ts_tpl, event_type))) AS m,"
        " BF_AGG(collect_set(LOCATION_HASH(ts_tpl))) AS b FROM joined GROUP BY rid"
    )
    sig = sketches.minhash_signature(df, ["rid"]).withColumnRenamed("minhash_signature", "m")
    bloom = sketches.bloom_filter(df, ["rid"]).withColumnRenamed("bloom_filter_base64", "b")
    assert sorted(sql.collect()) == sorted(sig.join(bloom, "rid").collect())
    noisy = spark.sql("SELECT AddLaplaceNoise(count(*)) AS n, AddLaplaceNoise(NULL) AS z FROM joined").first()
    assert isinstance(noisy.n, float) and noisy.z is None


def test_inflate_keeps_good_bodies(spark):
    bodies = [gzip.compress(b"<P/>"), zlib.compress(b"<P/>"), b"garbage", None]
    df = spark.createDataFrame([(b,) for b in bodies], "b binary").select(inflate("b").alias("x"))
    assert [None if r.x is None else bytes(r.x) for r in df.collect()] == [b"<P/>", b"<P/>", None, None]


def _raw_deflate(data: bytes) -> bytes:
    packer = zlib.compressobj(wbits=-15)
    return packer.compress(data) + packer.flush()


def test_inflate_any(spark):
    text = b"<Pport>" + b"x" * 100 + b"</Pport>"
    head = b"\x1f\xfd" + bytes(8)
    cases = {
        "plain": b"  " + text,
        "gzip_header": b"\x1f\xfd" + gzip.compress(text)[2:],
        "header_zlib": head + zlib.compress(text),
        "header_deflate": head + _raw_deflate(text),
        "deflate": _raw_deflate(text),
        "zlib": zlib.compress(text),
        "gzip": gzip.compress(text),
    }
    for key in (0xFD, 0x8B, 0x1F):
        cases[f"xor_{key:02x}"] = head + bytes(b ^ key for b in _raw_deflate(text))
    cases["nothing"] = b"\x00\x01\x02"
    cases["not_xml"] = gzip.compress(b"hello")
    df = spark.createDataFrame(list(cases.items()), "name string, b binary")
    got = {r.name: (r.o.strategy, r.o.body) for r in df.select("name", inflate_any("b").alias("o")).collect()}
    for name, (strategy, body) in got.items():
        if name in ("nothing", "not_xml"):
            assert (strategy, body) == (None, None)
        else:
            assert strategy == name and bytes(body).strip() == text


def test_text_of_bytes(spark):
    rows = [("Zürich".encode("utf-8"),), ("Zürich".encode("latin-1"),)]
    df = spark.createDataFrame(rows, "b binary").select(as_text(F.col("b")).alias("t"))
    assert [r.t for r in df.collect()] == ["Zürich", "Zürich"]


def test_preview(spark):
    packed = gzip.compress("é".encode() * 300).decode("latin-1")
    short = gzip.compress(b"short").decode("latin-1")
    rows = [(None,), ("a" * 200,), ("b" * 201,), (packed,), (short,), ("\x1f\x8bnot gzip",)]
    df = spark.createDataFrame(rows, "m string").select(preview(F.col("m")).alias("p"))
    assert [r.p for r in df.collect()] == [
        "Received null message",
        "a" * 200,
        "Received message: " + "b" * 200 + "...",
        "Decoded (decompressed): " + "é" * 200 + "...",
        "short",
        "\x1f\x8bnot gzip",
    ]


def test_noise_parameters():
    for bad in (0, -1):
        with pytest.raises(ValueError):
            noise.laplace_noise(bad, 1.0)
        with pytest.raises(ValueError):
            noise.laplace_noise(1.0, bad)


@pytest.mark.parametrize("secret", [None, "s"])
def test_noise_distribution(spark, secret):
    uniform = noise.keyed_uniform(secret, F.col("id")) if secret else None
    noisy = noise.add_laplace_noise(F.lit(10), 2.0, 1.0, uniform)
    df = spark.range(100_000).select((noisy - 10).alias("x"))
    mean, spread, size = df.agg(F.avg("x"), F.var_pop("x"), F.avg(F.abs("x"))).first()
    # Laplace with scale 2: variance 8, mean absolute value 2
    assert abs(mean) < 0.06 and abs(spread - 8) < 0.4 and abs(size - 2) < 0.04
    assert df.filter("x IS NULL OR isnan(x)").count() == 0


def test_keyed_noise_repeats(spark):
    df = spark.range(100).select(noise.keyed_uniform("s", F.col("id")).alias("u"))
    first, again = df.collect(), df.repartition(3).collect()
    assert sorted(first) == sorted(again)
    assert all(-0.5 < r.u < 0.5 and not math.isnan(r.u) for r in first)
    assert len({r.u for r in first}) == 100


def test_noise_of_null(spark):
    assert _one(spark, noise.add_laplace_noise(F.lit(None).cast("bigint"))) is None
