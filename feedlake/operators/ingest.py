"""From message bodies to flat rows: parse, route, flatten.

A message table has ``body`` (decoded XML text) and may carry the delivery headers
``message_type``, ``pp_sequence`` and ``processing_ts`` (receipt time, epoch
seconds); every operator here is a narrow transform of it, without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.functions.expressions import dated, flag, with_once
from feedlake.functions.payload import as_text, inflate, inflate_any

HEADERS = ("processing_ts", "pp_sequence")

# Header message types that are known and not used.
IGNORED_TYPES = ("SC", "AS", "OW", "TA", "TO", "TD", "LA")


def decode_payload(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Inflate gzip/zlib payloads to ``body``; messages that do not inflate are dropped."""
    decoded = with_once(messages, "_raw", inflate(F.col(payload))).filter("_raw IS NOT NULL")
    return decoded.withColumn("body", as_text(F.col("_raw"))).drop("_raw", payload)


def decode_payload_any(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Try every known encoding; ``strategy`` names the one that gave XML, undecodable rows are dropped."""
    decoded = with_once(messages, "_out", inflate_any(F.col(payload))).filter("_out.body IS NOT NULL")
    return decoded.select(
        *[c for c in messages.columns if c != payload],
        F.col("_out.strategy").alias("strategy"),
        as_text(F.col("_out.body")).alias("body"),
    )


def parse_feed(messages: DataFrame, body: str = "body") -> DataFrame:
    """Replace ``body`` by the parsed ``doc``; documents without the required root attributes are dropped."""
    doc = F.from_xml(F.col(body), schemas.FEED, {"ignoreNamespace": "true"})
    parsed = with_once(messages, "doc", doc).drop(body)
    return parsed.filter("doc._ts IS NOT NULL AND doc._version IS NOT NULL")


def route_messages(parsed: DataFrame, ts_first: bool = True) -> DataFrame:
    """Add ``container``, its content as ``box``, and ``msg_type``.

    Updates go before snapshots. With ``ts_first`` a container holding both status
    and schedule elements counts as status only; otherwise as ``TS+schedule``.
    """
    doc = F.col("doc")
    container = (
        F.when(doc["uR"].isNotNull(), "uR")
        .when(doc["sR"].isNotNull(), "sR")
        .when(doc["FailureResp"].isNotNull(), "FailureResp")
        .otherwise("none")
    )
    header = F.col("message_type") if "message_type" in parsed.columns else F.lit(None).cast("string")
    box = F.col("box")
    has_ts, has_schedule = F.size(box["TS"]) > 0, F.size(box["schedule"]) > 0
    both = F.lit("TS" if ts_first else "TS+schedule")
    content = (
        F.when(has_ts & has_schedule, both)
        .when(has_ts, "TS")
        .when(has_schedule, "schedule")
        .when(F.size(box["association"]) > 0, "association")
        .otherwise("other")
    )
    without_content = (
        F.when(F.col("container") == "FailureResp", "failure")
        .when(header == "TS", "unexpected")
        .when(header.isin(*IGNORED_TYPES), "ignored")
        .otherwise("unhandled")
    )
    routed = parsed.withColumn("container", container).withColumn("box", F.coalesce(doc["uR"], doc["sR"]))
    return routed.withColumn("msg_type", F.when(box.isNotNull(), content).otherwise(without_content))


def _headers(df: DataFrame) -> list[Column]:
    kinds = {"processing_ts": "double", "pp_sequence": "string"}
    return [
        (F.col(h) if h in df.columns else F.lit(None)).cast(kinds[h]).alias(h) for h in HEADERS
    ]


def _carry(df: DataFrame) -> list[Column]:
    return [F.col(c) for c in ("container", *HEADERS) if c in df.columns]


def flatten_ts(routed: DataFrame) -> DataFrame:
    """One row per location of every status message, in the ``TS_UPDATE`` layout plus ``container``.

    The event is the arrival if there is one, else the departure, else the pass.
    """
    status = routed.filter(F.col("msg_type").contains("TS")).select(
        *_carry(routed), F.explode("box.TS").alias("ts")
    )
    rows = status.select(*_carry(status), "ts", F.explode("ts.Location").alias("loc"))
    ts, loc = F.col("ts"), F.col("loc")
    event = F.coalesce(loc["arr"], loc["dep"], loc["pass"])
    event_type = (
        F.when(loc["arr"].isNotNull(), "arr")
        .when(loc["dep"].isNotNull(), "dep")
        .when(loc["pass"].isNotNull(), "pass")
        .otherwise("none")
    )
    plat = loc["plat"]
    forecast = F.coalesce(event["_at"], event["_et"])
    day = ts["_ssd"]
    suppressed = flag(plat["_platsup"], False) | flag(plat["_cisPlatsup"], False)
    return rows.select(
        "container",
        ts["_rid"].alias("rid"),
        ts["_uid"].alias("uid"),
        day.alias("ssd"),
        loc["_tpl"].alias("tpl"),
        loc["_pta"].alias("pta"),
        loc["_ptd"].alias("ptd"),
        event_type.alias("event_type"),
        forecast.alias("forecast_time"),
        event["_et"].alias("estimated_time"),
        event["_at"].alias("actual_time"),
        dated(day, loc["_pta"]).alias("pta_timestamp"),
        dated(day, loc["_ptd"]).alias("ptd_timestamp"),
        dated(day, forecast).alias("forecast_timestamp"),
        dated(day, event["_et"]).alias("estimated_timestamp"),
        dated(day, event["_at"]).alias("actual_timestamp"),
        flag(event["_delayed"], False).alias("is_delayed"),
        event["_src"].alias("forecast_source"),
        plat["_VALUE"].alias("platform"),
        flag(plat["_conf"], False).alias("platform_confirmed"),
        F.when(plat.isNotNull(), F.coalesce(plat["_platsrc"], F.lit("P"))).alias("platform_source"),
        suppressed.alias("platform_suppressed"),
        loc["_wta"].alias("wta"),
        loc["_wtd"].alias("wtd"),
        loc["_wtp"].alias("wtp"),
        *_headers(rows),
    )


def flatten_schedule(routed: DataFrame) -> DataFrame:
    """One row per calling point of every schedule, in the ``SCHEDULE_LOCATION`` layout plus ``container``.

    Points come kind by kind in the order of ``LOCATION_KINDS``; points without a
    location code are dropped.
    """
    plans = routed.filter(F.col("msg_type").contains("schedule")).select(
        *_carry(routed), F.explode("box.schedule").alias("s")
    )

    def labelled(kind: str) -> Column:
        points = F.coalesce(F.col("s")[kind], F.array().cast(f"array<{schemas.SCHEDULE_POINT.simpleString()}>"))
        return F.transform(points, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("p")))

    rows = plans.select(
        *_carry(plans), "s", F.inline(F.concat(*[labelled(k) for k in schemas.LOCATION_KINDS]))
    ).filter(F.col("p._tpl") != "")
    s, p = F.col("s"), F.col("p")
    day, reason = s["_ssd"], F.col("s")["cancelReason"]
    clocks = ("pta", "ptd", "wta", "wtd", "wtp")
    return rows.select(
        "container",
        *[s[f"_{name}"].alias(name) for name in ("rid", "uid", "trainId", "rsid", "ssd", "toc")],
        F.coalesce(s["_status"], F.lit("P")).alias("status"),
        F.coalesce(s["_trainCat"], F.lit("OO")).alias("trainCat"),
        flag(s["_isPassengerSvc"], True).alias("isPassengerSvc"),
        flag(s["_isActive"], True).alias("isActive"),
        flag(s["_deleted"], False).alias("isDeleted"),
        flag(s["_isCharter"], False).alias("isCharter"),
        reason["_VALUE"].try_cast("smallint").alias("cancelReasonCode"),
        F.when(reason.isNotNull(), flag(reason["_near"], False)).alias("cancelReasonNear"),
        reason["_tiploc"].alias("cancelReasonTiploc"),
        F.col("kind").alias("location_type"),
        p["_tpl"].alias("tpl"),
        F.coalesce(p["_act"], F.lit("  ")).alias("activity"),
        p["_planAct"].alias("planned_activity"),
        flag(p["_can"], False).alias("cancelled_at_loc"),
        p["_fid"].alias("formation_id"),
        p["_avgLoading"].try_cast("int").alias("avg_loading"),
        F.coalesce(p["_rdelay"].try_cast("int"), F.lit(0)).alias("route_delay"),
        p["_fd"].alias("false_destination"),
        *[p[f"_{c}"].alias(c) for c in clocks],
        *[dated(day, p[f"_{c}"]).alias(f"{c}_timestamp") for c in clocks],
        *_headers(rows),
    )


def snapshot_target() -> Column:
    """Where a flattened row goes: updates to the topic, snapshots to their log."""
    return F.when(F.col("container") == "sR", "snapshot_log").otherwise("topic")


def snapshot_split(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(updates, snapshots) of flattened rows: only updates go on to the topics.

    Each of the two parses its input anew; to count or write both, add
    :func:`snapshot_target` as a column and do it in one pass.
    """
    is_snapshot = snapshot_target() == "snapshot_log"
    return flat.filter(~is_snapshot).drop("container"), flat.filter(is_snapshot).drop("container")


def message_headers(records: DataFrame) -> DataFrame:
    """``message_type, pp_sequence, processing_ts, payload`` of topic records with their headers.

    ``headers`` is the array of (key, binary value) pairs that a topic source gives
    with ``includeHeaders``; of a repeated key the last one counts. The receipt time is
    the record's ``timestamp``, in epoch seconds.
    """

    def header(name: str) -> Column:
        own = F.filter("headers", lambda h: h["key"] == name)
        return F.decode(F.try_element_at(own, F.lit(-1))["value"], "UTF-8")

    return records.select(
        header("MessageType").alias("message_type"),
        header("PushPortSequence").alias("pp_sequence"),
        (F.unix_micros("timestamp") / F.lit(1e6)).alias("processing_ts"),
        F.col("value").alias("payload"),
    )


def schedule_origin(parsed: DataFrame) -> DataFrame:
    """Journey id and origin point of every schedule (NULLs when it has no origin)."""
    plans = parsed.select(F.explode(F.coalesce(F.col("doc.uR.schedule"), F.col("doc.sR.schedule"))).alias("s"))
    origin = F.get(F.col("s.OR"), F.lit(0))
    return plans.select(
        F.col("s._rid").alias("rid"), *[origin[f"_{c}"].alias(c) for c in ("tpl", "wta", "wtd", "wtp")]
    )


# Fields kept per kind of record.
EXTRACTS = {"schedule": ("rid", "tpl", "wta", "wtd", "wtp"), "forecast": ("pta", "ptd", "et", "at")}


def extract_fields(records: DataFrame, kind: str, value: str = "value") -> DataFrame:
    """The kept fields of JSON records of one kind as columns; missing fields are NULL."""
    if kind not in EXTRACTS:
        raise ValueError(f"unknown record kind: {kind}")
    return records.select(
        *[F.get_json_object(value, f"$.{field}").alias(field) for field in EXTRACTS[kind]]
    )


def station_updates(parsed: DataFrame) -> DataFrame:
    """Nested view of update messages: request header, train, list of station updates."""
    box = F.col("doc.uR")

    def station(loc: Column) -> Column:
        plat = loc["plat"]
        return F.struct(
            loc["_tpl"].alias("stationCode"),
            loc["_wtp"].alias("workingTimePlanned"),
            loc["pass"]["_at"].alias("estimatedTime"),
            plat["_VALUE"].alias("platform"),
            F.when(plat.isNotNull(), F.coalesce(plat["_conf"] == "true", F.lit(False))).alias("platformConfirmed"),
        )

    train = F.explode_outer(box["TS"])
    rows = parsed.filter(box.isNotNull()).select(box.alias("u"), train.alias("t"))
    t = F.col("t")
    nothing = F.filter(F.array(station(F.lit(None).cast(schemas.TS_LOCATION))), lambda x: F.lit(False))
    return rows.select(
        F.col("u._updateOrigin").alias("updateOrigin"),
        F.col("u._requestSource").alias("requestSource"),
        F.col("u._requestID").alias("requestID"),
        F.struct(t["_rid"].alias("rid"), t["_uid"].alias("uid"), t["_ssd"].alias("ssd")).alias("train"),
        F.coalesce(F.transform(t["Location"], station), nothing).alias("stationUpdates"),
    )
