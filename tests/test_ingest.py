import gzip
import json

import pytest
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.operators import ingest, keyed
from feedlake.operators.validate import PUBLIC_TIME, validate_feed
from feedlake.plans import jobs

ROOT = '<Pport xmlns="urn:feed" xmlns:f="urn:status" xmlns:s="urn:plan" ts="2025-04-30T12:00:00" version="16.0">'
PLAN = (
    '<schedule rid="202504301" uid="C10001" trainId="2A01" ssd="2025-04-30" toc="GW">'
    '<s:PP tpl="ACTONW" wtp="12:05:30"/><s:OR tpl="PADTON" wtd="12:00" ptd="12:00"/><s:PP wtp="12:07"/>'
    '<s:DT tpl="RDNG" wta="12:30" rdelay="x" act="TF"/>'
    '<s:cancelReason tiploc="PADTON" near="true">104</s:cancelReason></schedule>'
)
STATUS = (
    '<TS rid="202504301" uid="C10001" ssd="2025-04-30">'
    '<f:Location tpl="PADTLL" wtp="12:01:00"><f:pass et="12:02" src="TD"/><f:plat conf="true">5</f:plat></f:Location>'
    '<f:Location tpl="RDNG" wta="12:30" wtd="12:31"><f:arr at="12:33" et="12:32"/><f:dep et="12:35" delayed="true"/>'
    '<f:plat platsup="true">7</f:plat></f:Location>'
    '<f:Location tpl="TWYFORD" pta="12:40"><f:dep delayed="1"/></f:Location>'
    '<f:Location tpl="SLOUGH"/></TS>'
)


def _doc(content):
    return f"{ROOT}{content}</Pport>"


def _update(*parts):
    return _doc('<uR updateOrigin="TD" requestID="7">' + "".join(parts) + "</uR>")


def _routed(spark, *bodies, ts_first=True, header="TS"):
    rows = [(i, header, f"s{i}", 1.5, b) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "n int, message_type string, pp_sequence string, processing_ts double, body string")
    return ingest.route_messages(ingest.parse_feed(df), ts_first)


def test_flatten_ts(spark):
    rows = {r.tpl: r for r in ingest.flatten_ts(_routed(spark, _update(STATUS))).collect()}
    assert set(rows) == {"PADTLL", "RDNG", "TWYFORD", "SLOUGH"}
    passed = rows["PADTLL"]
    assert (passed.event_type, passed.forecast_time, passed.actual_time) == ("pass", "12:02", None)
    assert (passed.platform, passed.platform_confirmed, passed.platform_source) == ("5", True, "P")
    assert passed.forecast_timestamp == "2025-04-30T12:02" and passed.actual_timestamp is None
    assert (passed.processing_ts, passed.pp_sequence, passed.forecast_source) == (1.5, "s0", "TD")
    arrived = rows["RDNG"]
    assert (arrived.event_type, arrived.forecast_time, arrived.actual_time) == ("arr", "12:33", "12:33")
    assert (arrived.estimated_time, arrived.is_delayed, arrived.platform_suppressed) == ("12:32", False, True)
    left = rows["TWYFORD"]
    assert (left.event_type, left.is_delayed, left.forecast_time, left.platform) == ("dep", True, None, None)
    assert left.pta_timestamp == "2025-04-30T12:40" and left.platform_source is None
    nothing = rows["SLOUGH"]
    assert (nothing.event_type, nothing.is_delayed, nothing.platform_confirmed) == ("none", False, False)


def test_flat_layouts(spark):
    routed = _routed(spark, _update(PLAN, STATUS), ts_first=False)
    for flat, schema in (
        (ingest.flatten_ts(routed), schemas.TS_UPDATE),
        (ingest.flatten_schedule(routed), schemas.SCHEDULE_LOCATION),
    ):
        got = [(f.name, f.dataType) for f in flat.drop("container").schema]
        assert got == [(f.name, f.dataType) for f in schema]


def test_flatten_schedule(spark):
    rows = ingest.flatten_schedule(_routed(spark, _update(PLAN))).collect()
    assert [(r.location_type, r.tpl) for r in rows] == [("OR", "PADTON"), ("PP", "ACTONW"), ("DT", "RDNG")]
    origin, _, last = rows
    assert (origin.status, origin.trainCat, origin.isPassengerSvc, origin.isDeleted) == ("P", "OO", True, False)
    assert (origin.cancelReasonCode, origin.cancelReasonNear, origin.cancelReasonTiploc) == (104, True, "PADTON")
    assert (origin.activity, origin.route_delay, origin.ptd_timestamp) == ("  ", 0, "2025-04-30T12:00")
    assert (last.activity, last.route_delay, last.wta_timestamp) == ("TF", 0, "2025-04-30T12:30")


@pytest.mark.parametrize(
    "body,header,expected",
    [
        (_update(STATUS, PLAN), "TS", ("uR", "TS")),
        (_update(PLAN), "SC", ("uR", "schedule")),
        (_update('<association tiploc="X" category="JJ"/>'), "AS", ("uR", "association")),
        (_update(), "OW", ("uR", "other")),
        (_doc(f"<sR>{STATUS}</sR>"), "TS", ("sR", "TS")),
        (_doc(f"<uR>{PLAN}</uR><sR>{STATUS}</sR>"), "TS", ("uR", "schedule")),
        (_doc('<FailureResp code="1">no</FailureResp>'), "TS", ("FailureResp", "failure")),
        (_doc(""), "TS", ("none", "unexpected")),
        (_doc(""), "OW", ("none", "ignored")),
        (_doc(""), "ZZ", ("none", "unhandled")),
    ],
)
def test_routes(spark, body, header, expected):
    row = _routed(spark, body, header=header).first()
    assert (row.container, row.msg_type) == expected


def test_broken_documents_are_dropped(spark):
    bodies = ["<bad", "", "not xml", _doc("<uR><TS"), '<Pport ts="x"><uR/></Pport>', _update(PLAN)]
    assert [r.n for r in _routed(spark, *bodies).select("n").collect()] == [5]


def test_both_kinds_unless_ts_first(spark):
    both = _update(STATUS, PLAN)
    assert ingest.flatten_schedule(_routed(spark, both)).count() == 0
    assert ingest.flatten_schedule(_routed(spark, both, ts_first=False)).count() == 3
    assert ingest.flatten_ts(_routed(spark, both, ts_first=False)).count() == 4


def test_snapshots_are_split_off(spark):
    flat = ingest.flatten_ts(_routed(spark, _update(STATUS), _doc(f"<sR>{STATUS}</sR>")))
    updates, snapshots = ingest.snapshot_split(flat)
    assert {r.pp_sequence for r in updates.collect()} == {"s0"}
    assert {r.pp_sequence for r in snapshots.collect()} == {"s1"}


@pytest.mark.parametrize(
    "old,new,reason",
    [
        ("", "", None),
        ('uid="C10001"', 'uid="C1"', "TS.uid,schedule.uid"),
        ('rid="202504301"', 'rid="20250430123456789"', "TS.rid,schedule.rid"),
        ('trainId="2A01"', 'trainId="AA01"', "schedule.trainId"),
        ('toc="GW"', "", "schedule.toc"),
        ('wtp="12:05:30"', 'wtp="25:00"', "PP.wtp"),
        ('wtd="12:00"', "", "OR.wtd"),
        ('et="12:02"', 'et="12:02:30"', "pass.et"),
        ('tpl="PADTLL"', 'tpl="TOOLONGX"', "Location.tpl"),
        (">5</f:plat>", ">5ABC</f:plat>", "plat.VALUE"),
        ('act="TF"', 'act="tf"', "DT.act"),
        ('ssd="2025-04-30"', 'ssd="2025-99-99"', "TS.ssd,schedule.ssd"),
        ('ssd="2025-04-30"', 'ssd="2024-02-29Z"', None),
        ('ssd="2025-04-30"', 'ssd="2025-02-29"', "TS.ssd,schedule.ssd"),
        ('trainId="2A01"', 'trainId="2A01" rsid="GW1"', "schedule.rsid"),
        ('trainId="2A01"', 'trainId="2A01" rsid="GW123400"', None),
        ('src="TD"', 'src="TD" srcInst="AB"', "pass.srcInst"),
        ('requestID="7"', 'requestID="a b"', "uR.requestID"),
    ],
)
def test_validation(spark, old, new, reason):
    plan = PLAN.replace('<s:PP wtp="12:07"/>', "")
    body = _update(STATUS, plan).replace(old, new) if old else _update(STATUS, plan)
    row = validate_feed(_routed(spark, body)).first()
    assert (row.reject_reason, row.valid) == (reason, reason is None)


def test_patterns_match_the_whole_text(spark):
    df = spark.createDataFrame([("12:30",), ("12:30\n",), ("\n12:30",)], "t string")
    assert [r[0] for r in df.select(PUBLIC_TIME.holds(F.col("t"))).collect()] == [True, False, False]


def test_missing_location_code_is_invalid(spark):
    assert validate_feed(_routed(spark, _update(PLAN))).first().reject_reason == "PP.tpl"


def test_origin_and_stations(spark):
    parsed = _routed(spark, _update(PLAN), _update(STATUS))
    origin = ingest.schedule_origin(parsed).collect()
    assert [tuple(r) for r in origin] == [("202504301", "PADTON", None, "12:00", None)]
    rows = sorted(ingest.station_updates(parsed).collect(), key=lambda r: len(r.stationUpdates))
    assert rows[0].train.rid is None and rows[0].stationUpdates == []
    first = rows[1].stationUpdates[0]
    assert (rows[1].updateOrigin, rows[1].requestID, rows[1].train.uid) == ("TD", "7", "C10001")
    assert (first.stationCode, first.workingTimePlanned, first.platform, first.platformConfirmed) == (
        "PADTLL", "12:01:00", "5", True,
    )
    assert rows[1].stationUpdates[3].platformConfirmed is None


def test_whole_ingest(spark):
    bodies = [gzip.compress(_update(STATUS).encode()), gzip.compress(_update(PLAN.replace('<s:PP wtp="12:07"/>', "")).encode()), b"junk"]
    df = spark.createDataFrame([(b,) for b in bodies], "payload binary")
    status, plans = jobs.feed_to_rows(df)
    assert status.count() == 4 and plans.count() == 3


def test_keyed_json(spark):
    good = {"rid": "1", "processing_ts": 1714478400.1239, "tpl": "X", "n": 5}
    values = [
        json.dumps(good),
        "\t " + json.dumps(good),
        json.dumps({**good, "rid": 1}),
        json.dumps({**good, "rid": None}),
        json.dumps({**good, "processing_ts": "1714478400"}),
        json.dumps({k: v for k, v in good.items() if k != "processing_ts"}),
        "[1]",
        "",
        "{broken",
        None,
        json.dumps({"rid": "2", "processing_ts": 5}),
    ]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    rows = keyed.parse_keyed_json(df, ("tpl", "n"))
    got = sorted(
        tuple(r) for r in rows.select("rid", F.unix_millis("event_time"), "tpl", "n").collect()
    )
    assert got == [("1", 1714478400123, "X", "5")] * 2 + [("2", 5000, None, None)]
    assert keyed.parse_keyed_json(df).columns == ["rid", "event_time", "payload"]


def test_keyed_json_survives_odd_records(spark):
    def record(seconds):
        return f'{{"rid": "1", "processing_ts": {seconds}}}'

    odd = [record(s) for s in ("1e300", "-1e300", "1e15", "-1e15", "null", "NaN")]
    odd += ["\ufeff" + record(5), '{"rid": "1", "rid": "2", "processing_ts": 5, "processing_ts": 6}', record("253402300799")]
    rows = keyed.parse_keyed_json(spark.createDataFrame([(v,) for v in odd], "value string"))
    got = sorted((r.rid, r.at) for r in rows.select("rid", F.unix_millis("event_time").alias("at")).collect())
    assert got == [("1", 253402300799000), ("2", 6000)]


def test_message_headers(spark):
    rows = [
        ([("MessageType", b"TS"), ("PushPortSequence", b"1"), ("PushPortSequence", b"2"), ("Other", None)], 1.5, b"x"),
        ([], 2.0, None),
        (None, None, b"y"),
    ]
    df = spark.createDataFrame(rows, "headers array<struct<key: string, value: binary>>, t double, value binary")
    df = df.withColumn("timestamp", F.timestamp_micros((F.col("t") * 1000000).cast("bigint")))
    got = [tuple(r) for r in ingest.message_headers(df).collect()]
    assert got == [("TS", "2", 1.5, b"x"), (None, None, 2.0, None), (None, None, None, b"y")]


def test_typed_json(spark):
    values = ['{"rid":"a","window_end":"w"}', '{"rid":"b","minhash_signature":"oops"}', "{}", "{bad", "", None]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    rows = keyed.typed_json(df, schemas.SIGNATURE).collect()
    assert sorted((r.rid or "", r.minhash_signature) for r in rows) == [("", None), ("a", None), ("b", None)]


def test_extracts(spark):
    df = spark.createDataFrame([('{"rid":"1","wta":"10:00","et":"x"}',)], "value string")
    assert tuple(ingest.extract_fields(df, "schedule").first()) == ("1", None, "10:00", None, None)
    assert ingest.extract_fields(df, "forecast").first().et == "x"
    with pytest.raises(ValueError):
        ingest.extract_fields(df, "other")
