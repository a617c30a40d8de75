"""The generic ``events`` table read as a journey feed.

    rid = user_id, location = 'L' + floor(value / 10), clock and day from ts

``signup`` and ``purchase`` rows play the schedule side, ``click``, ``error`` and
``view`` rows the status side, so both sides together are the whole table.
"""

from __future__ import annotations

import gzip
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


SCHEDULE_EVENTS = ("signup", "purchase")
STATUS_EVENTS = ("click", "error", "view")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def prepared(events: DataFrame) -> DataFrame:
    """``event_id, rid, uid, ssd, clock, tpl, zone, event_type, event_time, processing_ts, value``."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("rid"),
        F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 5, "0")).alias("uid"),
        F.date_format(ts, "yyyy-MM-dd").alias("ssd"),
        F.date_format(ts, "HH:mm:ss").alias("clock"),
        F.concat(F.lit("L"), F.floor(F.col("value") / 10).cast("string")).alias("tpl"),
        F.concat(F.lit("Z"), F.floor(F.col("value") / 50).cast("string")).alias("zone"),
        "event_type",
        ts.alias("event_time"),
        (F.unix_micros(ts) / F.lit(1e6)).alias("processing_ts"),
        "value",
    )


def schedule_side(prep: DataFrame) -> DataFrame:
    rows = prep.filter(F.col("event_type").isin(*SCHEDULE_EVENTS))
    clock = F.col("clock")
    return rows.select(
        "rid",
        "event_time",
        "uid",
        "tpl",
        clock.alias("wta"),
        clock.alias("wtd"),
        F.lit(None).cast("string").alias("wtp"),
        "processing_ts",
    )


def status_side(prep: DataFrame) -> DataFrame:
    rows = prep.filter(F.col("event_type").isin(*STATUS_EVENTS))
    clock = F.col("clock")
    nothing = F.lit(None).cast("string")
    return rows.select(
        "rid",
        "event_time",
        "tpl",
        F.substring(clock, 1, 5).alias("pta"),
        nothing.alias("ptd"),
        clock.alias("wta"),
        nothing.alias("wtd"),
        nothing.alias("wtp"),
        "event_type",
        F.when(F.col("event_type") != "error", clock).alias("actual_time"),
        F.substring(clock, 1, 5).alias("forecast_time"),
        "processing_ts",
    )


def as_records(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows as the JSON text the topics carry."""
    return rows.select(F.to_json(F.struct(*columns)).alias("value"))


def joined_like(prep: DataFrame) -> DataFrame:
    """Every event as a joined record: scheduled zone, reported location, event."""
    return prep.select(
        "rid", "event_time", F.col("zone").alias("sch_tpl"), F.col("tpl").alias("ts_tpl"), "event_type"
    )


# --- XML bodies ------------------------------------------------------------------


def _attrs(**values: Column | str) -> list[Column]:
    parts = []
    for name, value in values.items():
        text = F.lit(value) if isinstance(value, str) else value
        parts += [F.lit(f' {name}="'), text, F.lit('"')]
    return parts


def _element(name: str, attributes: list[Column], *children: Column) -> Column:
    if not children:
        return F.concat(F.lit(f"<{name}"), *attributes, F.lit("/>"))
    return F.concat(F.lit(f"<{name}"), *attributes, F.lit(">"), *children, F.lit(f"</{name}>"))


def feed_messages(prep: DataFrame) -> DataFrame:
    """One XML message per event, of a kind that depends on its type.

    ``click`` update with status; ``view`` snapshot with status; ``purchase`` update
    with schedule; ``signup`` update with both; ``error`` a failure response. Large
    values give platform and operator codes longer than the feed allows. Beside the
    failure responses of values below 20 stands a cut-off document each.
    """
    c = F.col
    minute = F.substring("clock", 1, 5)
    status = _element(
        "f:TS",
        _attrs(rid=c("rid"), uid=c("uid"), ssd=c("ssd")),
        _element(
            "f:Location",
            _attrs(tpl=c("tpl"), wtp=c("clock")),
            _element("f:pass", _attrs(et=minute, src="TD")),
            _element("f:plat", _attrs(conf="true"), F.concat("tpl", F.lit("A"))),
        ),
        _element(
            "f:Location",
            _attrs(tpl=c("zone"), wta=c("clock"), wtd=c("clock"), pta=minute),
            _element("f:arr", _attrs(at=minute, src="Trust")),
            _element("f:dep", _attrs(et=minute, delayed="true")),
            _element("f:plat", _attrs(platsup="true", platsrc="A"), F.lit("12")),
        ),
    )
    plan = _element(
        "schedule",
        _attrs(rid=c("rid"), uid=c("uid"), trainId="2A01", ssd=c("ssd"), toc=c("zone")),
        _element("s:OR", _attrs(tpl=c("zone"), act="TB", ptd=minute, wtd=c("clock"), avgLoading="40")),
        _element("s:PP", _attrs(tpl=c("tpl"), wtp=c("clock"), rdelay="3")),
        _element("s:IP", _attrs(tpl="MID", wta=c("clock"), wtd=c("clock"), can="true")),
        _element("s:DT", _attrs(tpl="END", act="TF", wta=c("clock"), rdelay="x")),
        _element("s:cancelReason", _attrs(tiploc=c("zone"), near="true"), F.lit("104")),
    )
    update = _attrs(updateOrigin="TD", requestID=c("event_id").cast("string"))
    content = (
        F.when(c("event_type") == "click", _element("uR", update, status))
        .when(c("event_type") == "view", _element("sR", [], status))
        .when(c("event_type") == "purchase", _element("uR", update, plan))
        .when(c("event_type") == "signup", _element("uR", update, plan, status))
        .otherwise(_element("FailureResp", _attrs(code="E1"), F.lit("failed")))
    )
    root = _attrs(
        **{"xmlns": "urn:feed", "xmlns:f": "urn:feed:status", "xmlns:s": "urn:feed:schedule"},
        ts=F.concat(c("ssd"), F.lit("T"), c("clock")),
        version="16.0",
    )
    body = _element("Pport", root, content)
    cut = F.when((c("event_type") == "error") & (c("value") < 20), F.lit("<Pport><uR><TS"))
    return prep.select(
        "event_id",
        F.when(c("event_type") == "error", "LA").otherwise("TS").alias("message_type"),
        c("event_id").cast("string").alias("pp_sequence"),
        "processing_ts",
        F.explode(F.array_compact(F.array(body, cut))).alias("body"),
    )


# --- compressed bodies -------------------------------------------------------------


@F.pandas_udf(T.BinaryType())
def deflate(texts: pd.Series, codec: pd.Series) -> pd.Series:
    """Compress text the way a sender names it; the counterpart of the decoders."""

    def raw(data: bytes) -> bytes:
        packer = zlib.compressobj(wbits=-15)
        return packer.compress(data) + packer.flush()

    encode = {
        "plain": lambda d: d,
        "gzip": lambda d: gzip.compress(d, mtime=0),
        "zlib": zlib.compress,
        "deflate": raw,
        "gzip_header": lambda d: b"\x1f\xfd" + gzip.compress(d, mtime=0)[2:],
        "xor_8b": lambda d: b"\x1f\xfd" + bytes(8) + raw(d).translate(bytes(b ^ 0x8B for b in range(256))),
        "broken": lambda d: b"\x00\x01" + d[:8],
    }
    return pd.Series(
        [None if t is None else encode[k](t.encode("utf-8")) for t, k in zip(texts, codec)], dtype="object"
    )
