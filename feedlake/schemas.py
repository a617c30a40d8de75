"""Record contracts between the jobs, and the schema of the XML feed."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, BOOLEAN, LONG, DOUBLE = T.StringType(), T.BooleanType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _strings(*names: str) -> T.StructType:
    return _struct(**dict.fromkeys(names, STRING))


_KINDS = {
    "STRING": STRING,
    "BOOLEAN": BOOLEAN,
    "DOUBLE": DOUBLE,
    "INT": T.IntegerType(),
    "SMALLINT": T.ShortType(),
}


def _declared(columns: str) -> T.StructType:
    """Schema from ``name TYPE`` pairs, without needing a running session."""
    pairs = (column.split() for column in columns.split(","))
    return _struct(**{name: _KINDS[kind] for name, kind in pairs})


# The field names of the records and of the feed.

# --- flat records --------------------------------------------------------------

RAW_MESSAGE = _strings("message")

TS_UPDATE = _declared(
    "rid STRING, uid STRING, ssd STRING, tpl STRING, pta STRING, ptd STRING, event_type STRING,"
    " forecast_time STRING, estimated_time STRING, actual_time STRING, pta_timestamp STRING,"
    " ptd_timestamp STRING, forecast_timestamp STRING, estimated_timestamp STRING,"
    " actual_timestamp STRING, is_delayed BOOLEAN, forecast_source STRING, platform STRING,"
    " platform_confirmed BOOLEAN, platform_source STRING, platform_suppressed BOOLEAN,"
    " wta STRING, wtd STRING, wtp STRING, processing_ts DOUBLE, pp_sequence STRING"
)

SCHEDULE_LOCATION = _declared(
    "rid STRING, uid STRING, trainId STRING, rsid STRING, ssd STRING, toc STRING, status STRING,"
    " trainCat STRING, isPassengerSvc BOOLEAN, isActive BOOLEAN, isDeleted BOOLEAN,"
    " isCharter BOOLEAN, cancelReasonCode SMALLINT, cancelReasonNear BOOLEAN,"
    " cancelReasonTiploc STRING, location_type STRING, tpl STRING, activity STRING,"
    " planned_activity STRING, cancelled_at_loc BOOLEAN, formation_id STRING, avg_loading INT,"
    " route_delay INT, false_destination STRING, pta STRING, ptd STRING, wta STRING, wtd STRING,"
    " wtp STRING, pta_timestamp STRING, ptd_timestamp STRING, wta_timestamp STRING,"
    " wtd_timestamp STRING, wtp_timestamp STRING, processing_ts DOUBLE, pp_sequence STRING"
)

JOINED = _strings(
    "rid", "uid", "sch_tpl", "sch_wta", "sch_wtd", "sch_wtp", "ts_tpl", "ts_pta", "ts_ptd",
    "ts_wta", "ts_wtd", "ts_wtp", "event_type", "actual_time",
)
SIGNATURE = _struct(rid=STRING, window_end=STRING, minhash_signature=T.ArrayType(LONG))
SIMILARITY = _struct(window_end=STRING, rid1=STRING, rid2=STRING, similarity=DOUBLE)
BLOOM = _strings("rid", "window_end", "bloom_filter_base64")
DP_COUNT = _struct(window_end=STRING, location=STRING, noisy_count=DOUBLE)

# --- XML feed ------------------------------------------------------------------
# Attributes carry the "_" prefix of Spark's XML reader, element text is "_VALUE".
# Every leaf is read as STRING: a value that breaks its declared type then reaches
# the facet checks instead of voiding the whole message.

LOCATION_KINDS = ("OR", "OPOR", "IP", "OPIP", "PP", "DT", "OPDT")

SCHEDULE_POINT = _strings(
    "_tpl", "_act", "_planAct", "_can", "_fid", "_avgLoading", "_rdelay", "_fd",
    "_pta", "_ptd", "_wta", "_wtd", "_wtp",
)
SCHEDULE = T.StructType(
    _strings(
        "_rid", "_uid", "_trainId", "_rsid", "_ssd", "_toc", "_status", "_trainCat",
        "_isPassengerSvc", "_isActive", "_deleted", "_isCharter",
    ).fields
    + [T.StructField(kind, T.ArrayType(SCHEDULE_POINT)) for kind in LOCATION_KINDS]
    + [T.StructField("cancelReason", _strings("_VALUE", "_near", "_tiploc"))]
)
TIME_DATA = _strings(
    "_et", "_wet", "_at", "_atRemoved", "_atClass", "_etmin", "_etUnknown", "_delayed", "_src",
    "_srcInst",
)
PLATFORM = _strings("_VALUE", "_platsup", "_cisPlatsup", "_platsrc", "_conf")
TS_LOCATION = T.StructType(
    _strings("_wta", "_wtd", "_wtp", "_pta", "_ptd", "_tpl").fields
    + [T.StructField(event, TIME_DATA) for event in ("arr", "dep", "pass")]
    + [T.StructField("plat", PLATFORM), T.StructField("length", STRING)]
)
TRAIN_STATUS = T.StructType(
    _strings("_rid", "_uid", "_ssd", "_isReverseFormation").fields
    + [T.StructField("Location", T.ArrayType(TS_LOCATION))]
)
ASSOCIATION = _strings("_tiploc", "_category")
CONTAINER_FIELDS = [
    T.StructField("TS", T.ArrayType(TRAIN_STATUS)),
    T.StructField("schedule", T.ArrayType(SCHEDULE)),
    T.StructField("association", T.ArrayType(ASSOCIATION)),
]
UPDATE = T.StructType(
    _strings("_updateOrigin", "_requestSource", "_requestID").fields + CONTAINER_FIELDS
)
FEED = T.StructType(
    _strings("_ts", "_version").fields
    + [
        T.StructField("uR", UPDATE),
        T.StructField("sR", UPDATE),
        T.StructField("FailureResp", _strings("_VALUE", "_code")),
    ]
)
