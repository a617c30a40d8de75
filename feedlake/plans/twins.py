"""The registered queries once more, as SQL for an independent engine.

Written against the plain tables with list functions and window functions only, so
that each result is derived a second way.
"""

from __future__ import annotations

from feedlake.functions.hashing import MERSENNE_31, coefficients
from feedlake.operators.delays import VECTOR_LENGTH, planes
from feedlake.operators.sketches import (
    FILTER_BITS,
    FILTER_HASHES,
    FILTER_SEED,
    SIGNATURE_LENGTH,
    SIGNATURE_SEED,
)
from feedlake.plans.registry import CODECS, DIMENSIONS, PLANES, SECRET

_STAMP = "'%Y-%m-%d %H:%M:%S.%g'"
_END = "time_bucket(INTERVAL '1 day', {0}) + INTERVAL '1 day'"


def _end_text(ts: str = "ts") -> str:
    return f"strftime({_END.format(ts)}, {_STAMP})"


PREP = f"""
prep AS (
  SELECT event_id, ts, value, event_type,
         CAST(user_id AS VARCHAR) AS rid,
         'U' || lpad(CAST(user_id AS VARCHAR), 5, '0') AS uid,
         strftime(ts, '%Y-%m-%d') AS ssd,
         strftime(ts, '%H:%M:%S') AS clock,
         strftime(ts, '%H:%M') AS minute,
         'L' || CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR) AS tpl,
         'Z' || CAST(CAST(floor(value / 50) AS BIGINT) AS VARCHAR) AS zone,
         epoch_us(ts) / 1e6 AS processing_ts,
         {_end_text()} AS window_end
  FROM events),
sched AS (SELECT * FROM prep WHERE event_type IN ('signup', 'purchase')),
stat AS (
  SELECT *, CASE WHEN event_type <> 'error' THEN clock END AS actual_time,
         CASE WHEN event_type <> 'error' THEN clock ELSE minute || ':00' END AS reported
  FROM prep WHERE event_type IN ('click', 'error', 'view'))"""


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([PREP, *ctes]) + "\n" + body


def _hash(text: str) -> str:
    """32-bit string hash over UTF-16 units as a list reduction."""
    units = (
        f"flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN unicode(c) < 65536"
        " THEN [CAST(unicode(c) AS BIGINT)] ELSE [CAST(55296 + (unicode(c) - 65536) // 1024 AS BIGINT),"
        " CAST(56320 + (unicode(c) - 65536) % 1024 AS BIGINT)] END))"
    )
    folded = (
        f"list_reduce(list_prepend(CAST(0 AS BIGINT), {units}), lambda h, c: (h * 31 + c) & 4294967295)"
    )
    return f"(({folded} + 2147483648) % 4294967296 - 2147483648)"


def _pairs(name: str, count: int, seed: int) -> str:
    rows = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(coefficients(count, seed)))
    return f"{name}(i, a, b) AS (SELECT CAST(i AS BIGINT), CAST(a AS BIGINT), CAST(b AS BIGINT) FROM (VALUES {rows}) AS t(i, a, b))"


def _mod(expr: str, m: int) -> str:
    return f"((({expr}) % {m} + {m}) % {m})"


SIG = _pairs("sig", SIGNATURE_LENGTH, SIGNATURE_SEED)
BLO = _pairs("blo", FILTER_HASHES, FILTER_SEED)


def _minima(source: str, features: str, keys: str, name: str) -> str:
    """CTEs: distinct features of ``source`` hashed, then minima per key and position as ``name``."""
    return f"""
{name}_h AS (SELECT {keys}, {_hash('f')} AS h FROM (SELECT DISTINCT {keys}, {features} AS f FROM {source})),
{name} AS (SELECT {keys}, i, min({_mod('a * h + b', MERSENNE_31)}) AS v FROM {name}_h, sig GROUP BY {keys}, i)"""


_FEATURE = "concat_ws('|', zone, tpl, event_type)"
_DAILY = _minima("prep", _FEATURE, "rid, window_end", "daily")
_OVERALL = _minima("prep", _FEATURE, "rid", "overall")

_DAILY_TEXT = "SELECT rid, window_end, string_agg(CAST(v AS VARCHAR), ',' ORDER BY i) AS signature FROM daily"

_PAIRS_OF = """
SELECT l.window_end, l.rid AS rid1, r.rid AS rid2, count(*) / 128.0::DOUBLE AS similarity
FROM {0} l JOIN {0} r ON l.window_end = r.window_end AND l.i = r.i AND l.v = r.v AND l.rid < r.rid
GROUP BY ALL HAVING count(*) >= 13"""

_JOINED = """
joined AS (
  SELECT s.window_end, s.rid, s.uid, s.tpl AS sch_tpl, s.clock AS sch_wta, s.clock AS sch_wtd,
         'null' AS sch_wtp, t.tpl AS ts_tpl, t.minute AS ts_pta, 'null' AS ts_ptd,
         t.clock AS ts_wta, 'null' AS ts_wtd, 'null' AS ts_wtp, t.event_type,
         coalesce(t.actual_time, 'null') AS actual_time
  FROM sched s JOIN stat t ON s.rid = t.rid AND s.window_end = t.window_end)"""
_JOINED_NAMES = (
    "rid uid sch_tpl sch_wta sch_wtd sch_wtp ts_tpl ts_pta ts_ptd ts_wta ts_wtd ts_wtp event_type actual_time".split()
)
_JOINED_JSON = (
    "SELECT '{' || " + " || ',' || ".join(f"""'"{n}":"' || {n} || '"'""" for n in _JOINED_NAMES) + " || '}' AS value FROM joined"
)
_WINDOW_JOIN = _with("SELECT * EXCLUDE (window_end) FROM joined", _JOINED)

_NULLED = """
nulled AS (SELECT rid, window_end, tpl FROM prep
           UNION ALL SELECT rid, window_end, NULL FROM prep WHERE event_type = 'error'
           UNION ALL SELECT 'n' || rid, window_end, NULL FROM prep WHERE event_type = 'error')"""


def _bloom(source: str, keys: str, element: str, name: str) -> str:
    """CTEs: per key the list of set bits, then the Base64 text, as ``name``."""
    return f"""
{name}_e AS (SELECT DISTINCT {keys}, {element} AS e FROM {source}),
{name}_b AS (
  SELECT {keys}, list(DISTINCT p) FILTER (WHERE p IS NOT NULL) AS bits
  FROM (SELECT {keys}, CASE WHEN e IS NOT NULL THEN {_mod(f"a * {_hash('coalesce(e, chr(48))')} + b", FILTER_BITS)} END AS p
        FROM {name}_e, blo) GROUP BY {keys}),
{name}_t AS (SELECT {keys}, bits, {_bytes('bits')} AS hex FROM {name}_b),
{name} AS (SELECT {keys}, bits, to_base64(unhex(regexp_replace(hex, '^((?:..)*?)(?:00)+$', '\\1'))) AS bloom_filter_base64 FROM {name}_t)"""


def _bytes(bits: str) -> str:
    one = (
        f"list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(list_filter(coalesce({bits}, []), lambda p: p // 8 = i),"
        " lambda p: CAST(1 AS BIGINT) << CAST(p % 8 AS INTEGER))), lambda x, y: x | y)"
    )
    return f"list_aggregate(list_transform(range({FILTER_BITS // 8}), lambda i: printf('%02X', {one})), 'string_agg', '')"


_BLOOM = _NULLED + "," + _bloom("nulled", "rid, window_end", "tpl", "bl")
_VISITS = "event_type IN ('click', 'error', 'view')"
_COUNTS = f"""
counts AS (SELECT window_end, tpl AS location, count(DISTINCT rid) AS n_rids
           FROM prep WHERE {_VISITS} GROUP BY ALL)"""


def _closed(condition: str = "TRUE") -> str:
    """Windows an append-mode stream has closed: the watermark has passed their end."""
    newest = f"(SELECT max(ts) - INTERVAL '5 seconds' FROM prep WHERE {condition})"
    return f"CAST(window_end AS TIMESTAMP) <= {newest}"


def _noise(key: str, scale: float = 1.0) -> str:
    digest = f"sha256('{SECRET}|' || {key})"
    uniform = f"((CAST('0x' || substr({digest}, 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE - 0.5::DOUBLE)"
    return f"(-{scale}::DOUBLE * sign({uniform}) * ln(1 - 2 * abs({uniform})))"


_NOISY = f"round(n_rids + {_noise('window_end || chr(124) || location')}, 6) AS noisy_count"

_HAS_TS = "event_type IN ('click', 'view', 'signup')"
_PARSED = "TRUE"
_REASONS = f"""
reasons AS (SELECT event_id, nullif(concat_ws(',',
              CASE WHEN event_type IN ('click', 'view', 'signup') AND length(tpl) > 2 THEN 'plat.VALUE' END,
              CASE WHEN event_type IN ('purchase', 'signup') AND length(zone) <> 2 THEN 'schedule.toc' END), '')
            AS reject_reason FROM prep)"""


def _route(both: str) -> str:
    return f"""
SELECT event_id,
       CASE event_type WHEN 'view' THEN 'sR' WHEN 'error' THEN 'FailureResp' ELSE 'uR' END AS container,
       CASE event_type WHEN 'signup' THEN '{both}' WHEN 'purchase' THEN 'schedule'
                       WHEN 'error' THEN 'failure' ELSE 'TS' END AS msg_type
FROM prep WHERE {_PARSED}"""


_TS_ROWS = f"""
ts_rows AS (
  SELECT CASE event_type WHEN 'view' THEN 'sR' ELSE 'uR' END AS container, rid, uid, ssd, tpl,
         NULL AS pta, NULL AS ptd, 'pass' AS event_type, minute AS forecast_time,
         minute AS estimated_time, NULL AS actual_time, NULL AS pta_timestamp, NULL AS ptd_timestamp,
         ssd || 'T' || minute AS forecast_timestamp, ssd || 'T' || minute AS estimated_timestamp,
         NULL AS actual_timestamp, false AS is_delayed, 'TD' AS forecast_source, tpl || 'A' AS platform,
         true AS platform_confirmed, 'P' AS platform_source, false AS platform_suppressed,
         NULL AS wta, NULL AS wtd, clock AS wtp, processing_ts, CAST(event_id AS VARCHAR) AS pp_sequence
  FROM prep WHERE {_HAS_TS}
  UNION ALL
  SELECT CASE event_type WHEN 'view' THEN 'sR' ELSE 'uR' END, rid, uid, ssd, zone,
         minute, NULL, 'arr', minute, NULL, minute, ssd || 'T' || minute, NULL,
         ssd || 'T' || minute, NULL, ssd || 'T' || minute, false, 'Trust', '12', false, 'A', true,
         clock, clock, NULL, processing_ts, CAST(event_id AS VARCHAR)
  FROM prep WHERE {_HAS_TS})"""

_POINTS = """
points(location_type, activity, can, load, delay) AS (VALUES
  ('OR', 'TB', false, 40, 0), ('PP', '  ', false, NULL, 3), ('IP', '  ', true, NULL, 0), ('DT', 'TF', false, NULL, 0))"""
_SCHEDULE_ROWS = """
SELECT 'uR' AS container, rid, uid, '2A01' AS trainId, NULL AS rsid, ssd, zone AS toc, 'P' AS status,
       'OO' AS trainCat, true AS isPassengerSvc, true AS isActive, false AS isDeleted,
       false AS isCharter, CAST(104 AS SMALLINT) AS cancelReasonCode, true AS cancelReasonNear,
       zone AS cancelReasonTiploc, location_type,
       CASE location_type WHEN 'OR' THEN zone WHEN 'PP' THEN tpl WHEN 'IP' THEN 'MID' ELSE 'END' END AS tpl,
       activity, NULL AS planned_activity, can AS cancelled_at_loc, NULL AS formation_id,
       CAST(load AS INTEGER) AS avg_loading, CAST(delay AS INTEGER) AS route_delay,
       NULL AS false_destination, NULL AS pta,
       CASE location_type WHEN 'OR' THEN minute END AS ptd,
       CASE WHEN location_type IN ('IP', 'DT') THEN clock END AS wta,
       CASE WHEN location_type IN ('OR', 'IP') THEN clock END AS wtd,
       CASE WHEN location_type = 'PP' THEN clock END AS wtp,
       NULL AS pta_timestamp,
       CASE location_type WHEN 'OR' THEN ssd || 'T' || minute END AS ptd_timestamp,
       CASE WHEN location_type IN ('IP', 'DT') THEN ssd || 'T' || clock END AS wta_timestamp,
       CASE WHEN location_type IN ('OR', 'IP') THEN ssd || 'T' || clock END AS wtd_timestamp,
       CASE WHEN location_type = 'PP' THEN ssd || 'T' || clock END AS wtp_timestamp,
       processing_ts, CAST(event_id AS VARCHAR) AS pp_sequence
FROM sched, points"""

_STATION_JSON = """
'[{"stationCode":"' || tpl || '","workingTimePlanned":"' || clock
|| '","platform":"' || tpl || 'A","platformConfirmed":true},{"stationCode":"' || zone
|| '","platform":"12","platformConfirmed":false}]'"""

_CLOCK = (
    "(CAST(split_part({0}, ':', 1) AS DOUBLE) * 60 + CAST(split_part({0}, ':', 2) AS DOUBLE)"
    " + CAST(split_part({0}, ':', 3) AS DOUBLE) / 60)"
)
_DELAYS = f"""
planned AS (SELECT rid, tpl, arg_max(clock, (ts, clock)) AS planned FROM sched GROUP BY ALL),
gaps AS (
  SELECT t.rid, t.tpl, t.ts, {_CLOCK.format('t.reported')} - {_CLOCK.format('p.planned')} AS gap
  FROM stat t JOIN planned p ON t.rid = p.rid AND t.tpl = p.tpl),
delays AS (
  SELECT rid, tpl, ts, CASE WHEN gap > 720 THEN gap - 1440 WHEN gap < -720 THEN gap + 1440 ELSE gap END AS delay
  FROM gaps)"""
# The plan in force at the status row's own time, instead of the latest one.
_AS_OF = f"""
gaps AS (
  SELECT t.rid, t.tpl, t.ts, {_CLOCK.format('t.reported')} - {_CLOCK.format('p.planned')} AS gap
  FROM stat t ASOF JOIN (SELECT rid, tpl, ts, max(clock) AS planned FROM sched GROUP BY rid, tpl, ts) p
    ON t.rid = p.rid AND t.tpl = p.tpl AND t.ts >= p.ts),
delays AS (
  SELECT rid, tpl, ts, CASE WHEN gap > 720 THEN gap - 1440 WHEN gap < -720 THEN gap + 1440 ELSE gap END AS delay
  FROM gaps)"""
_VECTORS = f"""
newest AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY ts DESC, tpl DESC, delay DESC) AS k FROM delays),
vectors AS (SELECT rid, list(delay ORDER BY k DESC) AS v FROM newest WHERE k <= {VECTOR_LENGTH} GROUP BY rid)"""
_VECTOR_COLUMNS = "len(v) AS n, round(v[1], 6) AS first_delay, round(v[-1], 6) AS last_delay, round(list_sum(v), 6) AS total"


def _dot(vector: str, normal: list[float]) -> str:
    terms = [f"coalesce({vector}[{i + 1}], 0) * {c!r}::DOUBLE" for i, c in enumerate(normal)]
    return " + ".join(terms)


def _bucket(vector: str, count: int, dimensions: int) -> str:
    sides = [f"CASE WHEN {_dot(vector, n)} >= 0 THEN '1' ELSE '0' END" for n in planes(count, dimensions)]
    return " || ".join(sides)


_BUCKETS = f"buckets AS (SELECT rid, v, {_bucket('v', 4, VECTOR_LENGTH)} AS bucket FROM vectors)"
_MOMENTS = """
moments AS (SELECT bucket, count(*) AS n, avg(delay) AS mean, var_pop(delay) AS variance
            FROM delays JOIN buckets USING (rid) GROUP BY bucket)"""

_WIDE = ", ".join("[" + ", ".join(f"{c!r}" for c in n) + "]" for n in planes(PLANES, DIMENSIONS))

_CODEC = f"[{', '.join(repr(c) for c in CODECS)}][length(url) % {len(CODECS)} + 1]"

_UPSERTS = _with(
    """SELECT '{"rid":"' || rid || '","window_end":"' || window_end || '"}' AS key,
       '{"rid":"' || rid || '","window_end":"' || window_end || '","event_type":"'
       || arg_max(event_type, event_id) || '","event_id":' || max(event_id) || '}' AS value
       FROM prep GROUP BY rid, window_end"""
)

ORACLES: dict[str, str] = {
    "src_raw": "SELECT text AS message FROM documents",
    "src_json": _with(
        "SELECT rid, tpl AS ts_tpl, event_type FROM prep"
        " UNION ALL SELECT rid, tpl, NULL FROM prep WHERE event_type = 'view'"
    ),
    "src_replay": _with("SELECT rid, tpl, event_type, processing_ts FROM prep"),
    "sink_files": "SELECT text AS message FROM documents",
    "stream_archive": "SELECT text AS message FROM documents WHERE text IS NOT NULL",
    "sink_text": _with(
        """SELECT '{"event_id":' || event_id || ',"rid":"' || rid || '","tpl":"' || tpl || '"}' AS message FROM prep"""
    ),
    "sink_kafka_value": _with(
        """SELECT '{"window_end":"' || window_end || '","location":"' || location || '","n_rids":' || n_rids || '}' AS value FROM counts""",
        _COUNTS,
    ),
    "sink_keyed": _with(
        """SELECT rid AS key, '{"rid":"' || rid || '","event_id":' || event_id || ',"tpl":"' || tpl
           || '","event_type":"' || event_type || '"}' AS value FROM prep"""
    ),
    "sink_upsert": _UPSERTS,
    "stream_upsert": _UPSERTS,
    "multi_sink": _with(
        "SELECT window_end, location, n_rids, s AS sink FROM counts, (VALUES ('topic'), ('files')) AS t(s)", _COUNTS
    ),
    "decode_payload": (
        "SELECT doc_id, md5(text) AS body_md5, length(text) AS n_chars FROM documents"
    ),
    "decode_payload_any": (
        "SELECT page_id, strategy, md5('<P>' || html || '</P>') AS body_md5"
        f" FROM (SELECT *, {_CODEC} AS strategy FROM pages)"
    ),
    "payload_preview": """
SELECT doc_id, CASE
    WHEN lang = 'en' AND n_chars > 200 THEN 'Decoded (decompressed): ' || substr(text, 1, 200) || '...'
    WHEN lang = 'en' THEN text
    WHEN n_chars > 200 THEN 'Received message: ' || substr(text, 1, 200) || '...'
    ELSE text END AS preview
FROM documents UNION ALL SELECT doc_id, 'Received null message' FROM documents WHERE n_chars < 60""",
    "parse_feed": _with(
        f"""SELECT event_id, ssd || 'T' || clock AS ts, '16.0' AS version,
            CASE WHEN event_type IN ('click', 'purchase', 'signup') THEN 'TD' END AS update_origin,
            CASE WHEN {_HAS_TS} THEN 1 ELSE 0 END AS n_ts,
            CASE WHEN event_type IN ('purchase', 'signup') THEN 1 ELSE 0 END AS n_schedule,
            CASE WHEN event_type = 'error' THEN 'E1' END AS failure_code
            FROM prep WHERE {_PARSED}"""
    ),
    "route_messages": _with(_route("TS")),
    "route_messages_both": _with(_route("TS+schedule")),
    "validate_feed": _with(
        "SELECT event_id, reject_reason IS NULL AS valid, reject_reason FROM reasons", _REASONS
    ),
    "message_headers": _with(
        """SELECT CASE WHEN event_type <> 'error' THEN upper(substr(event_type, 1, 2)) END AS message_type,
           CAST(event_id AS VARCHAR) AS pp_sequence, processing_ts, tpl AS payload FROM prep"""
    ),
    "feed_pipeline": _with(
        """SELECT kind, rid, tpl, count(*) AS n, max(pp_sequence) AS last FROM both_kinds
           JOIN reasons ON pp_sequence = CAST(event_id AS VARCHAR) WHERE reject_reason IS NULL GROUP BY kind, rid, tpl""",
        _REASONS,
        _TS_ROWS,
        _POINTS,
        f"""both_kinds AS (SELECT 'status' AS kind, rid, tpl, pp_sequence FROM ts_rows
            UNION ALL SELECT 'schedule', rid, tpl, pp_sequence FROM ({_SCHEDULE_ROWS}))""",
    ),
    "feed_rejects": _with(
        """SELECT event_id, reject_reason FROM reasons WHERE reject_reason IS NOT NULL
           UNION ALL SELECT event_id, 'document' FROM prep WHERE event_type = 'error' AND value < 20
           UNION ALL SELECT event_id, 'payload' FROM prep WHERE event_type = 'view' AND value < 20""",
        _REASONS,
    ),
    "flatten_ts": _with("SELECT * FROM ts_rows", _TS_ROWS),
    "flatten_schedule": _with(_SCHEDULE_ROWS, _POINTS),
    "snapshot_split": _with(
        "SELECT rid, tpl, count(*) AS n, CASE container WHEN 'sR' THEN 'snapshot_log' ELSE 'topic' END AS target"
        " FROM ts_rows GROUP BY rid, tpl, target",
        _TS_ROWS,
    ),
    "schedule_origin": _with(
        "SELECT rid, zone AS tpl, CAST(NULL AS VARCHAR) AS wta, clock AS wtd, CAST(NULL AS VARCHAR) AS wtp FROM sched"
    ),
    "extract_fields": _with(
        "SELECT rid, tpl, clock AS wta, clock AS wtd, CAST(NULL AS VARCHAR) AS wtp FROM sched"
    ),
    "extract_forecast_fields": _with(
        'SELECT minute AS pta, CAST(NULL AS VARCHAR) AS ptd, CAST(NULL AS VARCHAR) AS et, actual_time AS "at" FROM stat'
    ),
    "station_updates": _with(
        f"""SELECT 'TD' AS "updateOrigin", CAST(event_id AS VARCHAR) AS "requestID",
            CASE WHEN event_type <> 'purchase' THEN rid END AS rid,
            CASE WHEN event_type <> 'purchase' THEN 2 ELSE 0 END AS n_stations,
            CASE WHEN event_type <> 'purchase' THEN {_STATION_JSON} ELSE '[]' END AS stations
            FROM prep WHERE event_type IN ('click', 'purchase', 'signup')"""
    ),
    "parse_keyed_json": _with(
        f"""SELECT rid, strftime(make_timestamp(CAST(trunc(processing_ts * 1000) AS BIGINT) * 1000), {_STAMP})
            AS event_time, tpl
            FROM (SELECT * FROM prep UNION ALL SELECT * FROM prep WHERE event_type = 'purchase')"""
    ),
    "filter_not_null": _with("SELECT event_id, rid FROM prep"),
    "filter_in": _with(f"SELECT event_id, rid, event_type FROM prep WHERE {_VISITS}"),
    "feature_string": _with(
        "SELECT event_id, CASE WHEN event_type <> 'error' THEN zone ELSE 'NULL' END || '|' || tpl || '|' || event_type"
        " AS feature FROM prep"
    ),
    "java_hash": f"SELECT doc_id, {_hash('text')} AS h FROM documents",
    "window_join": _WINDOW_JOIN,
    "joined_record": _with(_JOINED_JSON, _JOINED),
    "journey_features": _with(
        "SELECT DISTINCT window_end, rid, sch_tpl, ts_tpl, event_type FROM joined", _JOINED
    ),
    "minhash_signature": _with(_DAILY_TEXT + " GROUP BY rid, window_end", SIG, _DAILY),
    "minhash_merge": _with(
        "SELECT rid, string_agg(CAST(v AS VARCHAR), ',' ORDER BY i) AS signature FROM overall GROUP BY rid", SIG, _OVERALL
    ),
    "jaccard_estimate": _with(
        """SELECT d.rid, d.window_end, sum(CASE WHEN d.v = o.v THEN 1 ELSE 0 END) / 128.0::DOUBLE AS similarity
           FROM daily d JOIN overall o ON d.rid = o.rid AND d.i = o.i GROUP BY d.rid, d.window_end""",
        SIG, _DAILY, _OVERALL,
    ),
    "similarity_pairs": _with(_PAIRS_OF.format("daily"), SIG, _DAILY),
    "similarity_groups": _with(
        f"SELECT window_end, similarity, count(*) AS n_pairs FROM ({_PAIRS_OF.format('daily')}) GROUP BY ALL", SIG, _DAILY
    ),
    "journey_similarity": _with(
        _PAIRS_OF.format("joint"),
        _JOINED,
        SIG,
        _minima("joined", "concat_ws('|', sch_tpl, ts_tpl, event_type)", "rid, window_end", "joint"),
    ),
    "stream_chain": _with(
        _PAIRS_OF.format("joint"),
        _JOINED,
        SIG,
        _minima("joined", "concat_ws('|', sch_tpl, ts_tpl, event_type)", "rid, window_end", "joint"),
    ),
    "arrival_window_count": _with(
        f"""SELECT tpl AS location, CAST(count(DISTINCT rid) AS BIGINT) AS n_rids, CAST(1 AS BIGINT) AS windows
            FROM prep WHERE event_type IN ('click', 'error', 'view') GROUP BY tpl"""
    ),
    "bloom_agg": _with("SELECT rid, window_end, bloom_filter_base64 FROM bl", BLO, _BLOOM),
    "bloom_merge": _with(
        "SELECT rid, bloom_filter_base64 FROM whole", BLO, _NULLED, _bloom("nulled", "rid", "tpl", "whole")
    ),
    "bloom_might_contain": _with(
        f"""SELECT event_id,
            bool_and(list_contains(coalesce(bits, []), {_mod(f"a * {_hash('tpl')} + b", FILTER_BITS)})) AS has_tpl,
            bool_and(list_contains(coalesce(bits, []), {_mod(f"a * {_hash('zone')} + b", FILTER_BITS)})) AS has_zone
            FROM prep JOIN bl USING (rid, window_end), blo GROUP BY event_id""",
        BLO, _BLOOM,
    ),
    "sql_signatures": _with(_DAILY_TEXT + " GROUP BY rid, window_end", SIG, _DAILY),
    "sql_filters": _with("SELECT rid, window_end, bloom_filter_base64 FROM bl", BLO, _BLOOM),
    "sql_similarity": _with(
        """SELECT d.rid, d.window_end, sum(CASE WHEN d.v = o.v THEN 1 ELSE 0 END) / 128.0::DOUBLE AS similarity
           FROM daily d JOIN overall o ON d.rid = o.rid AND d.i = o.i GROUP BY d.rid, d.window_end""",
        SIG, _DAILY, _OVERALL,
    ),
    "distinct_count_window": _with("SELECT * FROM counts", _COUNTS),
    "dp_noisy_count": _with(f"SELECT window_end, location, {_NOISY} FROM counts", _COUNTS),
    "stream_window_join": _WINDOW_JOIN,
    "stream_minhash": _with(
        _DAILY_TEXT + " GROUP BY rid, window_end", SIG, _DAILY
    ),
    "stream_bloom": _with(
        "SELECT rid, window_end, bloom_filter_base64 FROM bl", BLO, _BLOOM
    ),
    "stream_dp_count": _with(
        f"SELECT window_end, location, {_NOISY} FROM counts", _COUNTS
    ),
    "stream_similarity": _with(_PAIRS_OF.format("daily"), SIG, _DAILY),
    "stream_window_pairs": _with(_PAIRS_OF.format("daily"), SIG, _DAILY),
    "late_drop": _with(
        f"""SELECT window_end, count(*) AS n FROM prep
            WHERE {_closed()} AND (event_type NOT IN ('signup', 'error')
                                   OR NOT {_closed("event_type NOT IN ('signup', 'error')")})
            GROUP BY window_end"""
    ),
    "delay_calc": _with(
        f"SELECT rid, tpl, strftime(ts, {_STAMP}) AS event_time, round(delay, 6) AS delay FROM delays", _DELAYS
    ),
    "delay_as_of": _with(
        f"SELECT rid, tpl, strftime(ts, {_STAMP}) AS event_time, round(delay, 6) AS delay FROM delays", _AS_OF
    ),
    "stream_delay": _with(
        f"SELECT rid, tpl, strftime(ts, {_STAMP}) AS event_time, round(delay, 6) AS delay FROM delays", _AS_OF
    ),
    "delay_vector": _with(f"SELECT rid, {_VECTOR_COLUMNS} FROM vectors", _DELAYS, _VECTORS),
    "stream_delay_vector": _with(f"SELECT rid, {_VECTOR_COLUMNS} FROM vectors", _DELAYS, _VECTORS),
    "running_delay_vector": _with(
        f"SELECT rid, tpl, strftime(ts, {_STAMP}) AS event_time, {_VECTOR_COLUMNS} FROM running",
        _DELAYS,
        f"""running AS (SELECT rid, tpl, ts, list(delay) OVER (PARTITION BY rid ORDER BY ts, tpl, delay
            ROWS BETWEEN {VECTOR_LENGTH - 1} PRECEDING AND CURRENT ROW) AS v FROM delays)""",
    ),
    "lsh_bucket": f"""
SELECT vec_id, list_aggregate(list_transform(CAST([{_WIDE}] AS DOUBLE[][]), lambda n:
       CASE WHEN list_dot_product(CAST(embedding AS DOUBLE[]), n) >= 0 THEN '1' ELSE '0' END), 'string_agg', '') AS bucket
FROM embeddings""",
    "lsh_bucket_gaps": f"""
WITH g AS (SELECT vec_id, CASE vec_id % 3 WHEN 0 THEN embedding[1:40]
                  WHEN 1 THEN list_transform(embedding, lambda x, i: CASE WHEN i - 1 <> vec_id % {DIMENSIONS} THEN x END)
                  ELSE list_concat(embedding, embedding[1:5]) END AS e FROM embeddings),
p AS (SELECT vec_id, list_transform(range(1, {DIMENSIONS} + 1), lambda i: coalesce(CAST(e[i] AS DOUBLE), 0)) AS e FROM g)
SELECT vec_id, list_aggregate(list_transform(CAST([{_WIDE}] AS DOUBLE[][]), lambda n:
       CASE WHEN list_dot_product(e, n) >= 0 THEN '1' ELSE '0' END), 'string_agg', '') AS bucket
FROM p""",
    "bucket_moments": _with(
        "SELECT bucket, n, round(mean, 5) AS mean, round(variance, 3) AS variance FROM moments",
        _DELAYS, _VECTORS, _BUCKETS, _MOMENTS,
    ),
    "stream_moments": _with(
        "SELECT bucket, n, round(mean, 5) AS mean, round(variance, 3) AS variance FROM moments",
        _DELAYS, _VECTORS, _BUCKETS, _MOMENTS,
    ),
    "dp_moments": _with(
        """SELECT bucket, round(n, 5) AS noisy_n, round(mean, 4) AS noisy_mean,
           round(greatest(0, least(14400, squares / greatest(n, 1) - mean * mean)), 2) AS noisy_variance
           FROM (SELECT *, greatest(-120, least(120, total / greatest(n, 1))) AS mean FROM drawn)""",
        _DELAYS,
        _VECTORS,
        _BUCKETS,
        f"""sums AS (SELECT bucket, count(*) AS n, sum(c) AS total, sum(c * c) AS squares
            FROM (SELECT bucket, greatest(-120, least(120, delay)) AS c FROM delays JOIN buckets USING (rid)) GROUP BY bucket),
drawn AS (SELECT bucket, n + {_noise("bucket || '|n'", 3.0)} AS n, total + {_noise("bucket || '|total'", 360.0)} AS total,
            squares + {_noise("bucket || '|squares'", 43200.0)} AS squares FROM sums)""",
    ),
    "dp_journey_moments": _with(
        """SELECT bucket, round(n, 5) AS noisy_n, round(mean, 4) AS noisy_mean,
           round(greatest(0, least(14400, squares / greatest(n, 1) - mean * mean)), 2) AS noisy_variance
           FROM (SELECT *, greatest(-120, least(120, total / greatest(n, 1))) AS mean FROM drawn)""",
        _DELAYS,
        _VECTORS,
        _BUCKETS,
        f"""sums AS (SELECT bucket, coalesce(n, 0) AS n, coalesce(total, 0) AS total, coalesce(squares, 0) AS squares
            FROM (SELECT lpad(bin(i), 4, '0') AS bucket FROM range(16) t(i)) LEFT JOIN (
              SELECT bucket, count(*) AS n, sum(c) AS total, sum(c * c) AS squares
              FROM (SELECT bucket, greatest(-120, least(120, unnest(v))) AS c FROM buckets) GROUP BY bucket) USING (bucket)),
drawn AS (SELECT bucket, n + {_noise("bucket || '|n|all days'", 15.0)} AS n, total + {_noise("bucket || '|total|all days'", 1800.0)} AS total,
            squares + {_noise("bucket || '|squares|all days'", 216000.0)} AS squares FROM sums)""",
    ),
    "explain_bucket": _with(
        """SELECT rid, bucket, 'Bucket ' || bucket || ': '
           || CASE WHEN v[1] <= 0 THEN 'no initial delay' WHEN v[1] < 5 THEN 'low initial delay' ELSE 'high initial delay' END
           || ', ' || CASE WHEN v[-1] - v[1] < -1 THEN 'recovering' WHEN v[-1] - v[1] > 1 THEN 'worsening' ELSE 'steady' END
           AS explanation FROM buckets""",
        _DELAYS, _VECTORS, _BUCKETS,
    ),
}
