"""DuckDB SQL for each registered query, written from the same recipes
(`plans/fixtures.py`) but with DuckDB's own JSON, regex and window
functions, so agreement is evidence rather than an echo.

Tables `events`, `pages`, ... are views the checker registers.
"""

from __future__ import annotations

from .. import constants as K
from . import queries as Q
from .fixtures import PAGE_SIZE

EV = ("ev AS (SELECT *, epoch_us(ts) // 1000 AS ms, CAST(event_id AS VARCHAR) AS id "
      "FROM events)")
N = "n AS (SELECT count(*) AS n FROM ev)"


def _q(x: str) -> str:
    return f"'\"' || {x} || '\"'"


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


RAW_JSON = f"""'{{' ||
  CASE WHEN event_id % 50 = 7 THEN {_q("(['id','eventId','_id','event_id'])[event_id % 4 + 1]")} || ':"null"'
       WHEN event_id % 50 = 17 THEN '"id":"","eventId":' || CASE WHEN event_id % 2 = 0 THEN id ELSE {_q("id")} END
       WHEN event_id % 50 = 27 THEN '"id":{{"n":' || id || '}}'
       WHEN event_id % 50 = 37 THEN '"id":false,"_id":null'
       WHEN event_id % 50 = 47 THEN '"id":null,"event_id":' || {_q("id")}
       ELSE {_q("(['id','eventId','_id','event_id'])[event_id % 4 + 1]")} || ':' ||
            CASE WHEN event_id % 2 = 0 THEN id ELSE {_q("id")} END END
  || ',' || {_q("(['type','eventType','event_type'])[event_id % 3 + 1]")} || ':' || {_q("event_type")}
  || ',' || {_q("CASE WHEN event_id % 7 = 0 THEN 'created_at' WHEN event_id % 7 = 1 THEN 'ts' ELSE 'timestamp' END")}
  || ':' || CASE WHEN event_id % 50 = 23 THEN '1000000000'
                 WHEN event_id % 50 = 33 THEN '"yesterday"'
                 WHEN event_id % 50 = 43 THEN 'null'
                 WHEN event_id % 3 = 0 THEN {_q("strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')")}
                 WHEN event_id % 3 = 1 THEN CAST(ms AS VARCHAR)
                 ELSE CAST(ms // 1000 AS VARCHAR) END
  || ',"user_id":' || CAST(user_id AS VARCHAR)
  || ',"value_cents":' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)
  || ',"props":' || props || '}}'"""

RAW = f"raw AS (SELECT event_id, ts, ms, event_type, user_id, id, {RAW_JSON} AS json FROM ev)"


def jkind(j: str, p: str) -> str:
    """JSON kind of `p` in text `j`: missing/null/string/number/boolean/object/array."""
    return (f"CASE WHEN json_type({j}, '{p}') IS NULL THEN 'missing' "
            f"WHEN json_type({j}, '{p}') = 'NULL' THEN 'null' "
            f"WHEN json_type({j}, '{p}') = 'VARCHAR' THEN 'string' "
            f"WHEN json_type({j}, '{p}') = 'BOOLEAN' THEN 'boolean' "
            f"WHEN json_type({j}, '{p}') = 'OBJECT' THEN 'object' "
            f"WHEN json_type({j}, '{p}') = 'ARRAY' THEN 'array' ELSE 'number' END")


def jtruthy(j: str, p: str) -> str:
    s = f"json_extract_string({j}, '{p}')"
    return (f"(CASE json_type({j}, '{p}') WHEN 'VARCHAR' THEN {s} <> '' "
            f"WHEN 'BOOLEAN' THEN {s} = 'true' WHEN 'NULL' THEN false "
            f"WHEN 'OBJECT' THEN true WHEN 'ARRAY' THEN true "
            f"ELSE coalesce(TRY_CAST({s} AS DOUBLE) <> 0, false) END)")


def _path(f: str) -> str:
    return f"$.{f}"


def jpick_text(j: str, fields=K.ID_FIELDS) -> str:
    whens = " ".join(f"WHEN {jtruthy(j, _path(f))} THEN json_extract_string({j}, '{_path(f)}')"
                     for f in fields)
    return f"(CASE {whens} END)"


def jpick_kind(j: str, fields=K.ID_FIELDS) -> str:
    whens = " ".join(f"WHEN {jtruthy(j, _path(f))} THEN {jkind(j, _path(f))}" for f in fields)
    return f"(CASE {whens} END)"


def jpick_field(j: str, fields=K.ID_FIELDS) -> str:
    whens = " ".join(f"WHEN {jtruthy(j, _path(f))} THEN '{f}'" for f in fields)
    return f"(CASE {whens} END)"


def jid(j: str, fields=K.ID_FIELDS) -> str:
    """Picked id text, NULL for object/array picks."""
    return (f"(CASE WHEN {jpick_kind(j, fields)} IN ('object', 'array') THEN NULL "
            f"ELSE {jpick_text(j, fields)} END)")


def valid(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '' AND {x} NOT IN ('undefined', 'null'))"


def elem_id(e: str) -> str:
    """Id of one array element (JSON text `e`)."""
    return (f"(CASE WHEN json_type({e}) = 'VARCHAR' THEN json_extract_string({e}, '$') "
            f"WHEN json_type({e}) = 'OBJECT' THEN {jid(e)} END)")


SRC = (f"src AS (SELECT id, event_id, event_type, ms FROM ev "
       f"WHERE event_id * 10 >= 4 * (SELECT n FROM n) AND event_id % 97 <> 0 "
       f"UNION ALL SELECT id, event_id, event_type, ms FROM ev "
       f"WHERE event_id * 10 < 6 * (SELECT n FROM n) AND event_id % 97 <> 0)")
TGT = "tgt AS (SELECT id, event_id, event_type, ms FROM ev WHERE event_id % 10 = 3)"
NEW = ("new AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id) AS rn "
       "FROM src WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.id = src.id)) WHERE rn = 1)")
LOADED = ("loaded AS (SELECT id, event_id, event_type, ms FROM tgt "
          "UNION ALL SELECT id, event_id, event_type, ms FROM new)")
SLICE = ", ".join([EV, N, SRC, TGT, NEW, LOADED])

DELIV = ("deliv AS ("
         "SELECT id, event_id, event_type, ms, 'feed' AS strategy, 0 * (SELECT n FROM n) + event_id AS seq, "
         "'feed:' || props AS payload FROM ev WHERE event_id % 2 = 0 "
         "UNION ALL SELECT id, event_id, event_type, ms, 'cursor-chain', 1 * (SELECT n FROM n) + event_id, "
         "'cursor-chain:' || props FROM ev WHERE event_id % 3 = 0 "
         "UNION ALL SELECT id, event_id, event_type, ms, 'type-worker', 2 * (SELECT n FROM n) + event_id, "
         "'type-worker:' || props FROM ev WHERE event_id % 5 = 0 OR (event_id % 2 <> 0 AND event_id % 3 <> 0))")
DTGT = "dtgt AS (SELECT id FROM ev WHERE event_id % 10 = 3)"
DELIVERIES = ", ".join([EV, N, DELIV, DTGT])

BATCHES = ("b AS (SELECT batch, events, known, ts_ms, events - known AS inserted, "
           "(['feed','cursor-chain','type-worker'])[batch % 3 + 1] AS strategy, "
           "'w' || CAST(batch % 6 AS VARCHAR) AS worker FROM ("
           "SELECT event_id // 20 AS batch, count(*) AS events, "
           "count(*) FILTER (WHERE event_id % 10 = 3) AS known, max(ms) AS ts_ms "
           "FROM ev GROUP BY 1))")

PAGED = (f"pg AS (SELECT *, idx // {PAGE_SIZE} AS page_no, max(idx // {PAGE_SIZE}) OVER () AS last_page "
         f"FROM (SELECT *, row_number() OVER (ORDER BY ts DESC, event_id DESC) - 1 AS idx FROM raw)), "
         f"pgc AS (SELECT page_no, arg_max(to_base64(encode(CAST(ms AS VARCHAR) || ':' || "
         f"CAST(event_id AS VARCHAR))), idx) AS cur FROM pg GROUP BY page_no)")

CKPT = ("ck AS (SELECT event_id AS seq, event_type AS strategy, "
        "CASE WHEN event_id % 40 = 39 THEN 'completed' ELSE 'running' END AS status, "
        "CAST(user_id AS VARCHAR) AS cursor, event_id AS events_count, "
        "CASE WHEN event_id % 3 <> 0 THEN '{\"page\":' || id || '}' ELSE '{}' END AS metadata, ms AS updated_at FROM ev)")

# Intent fold written with windows (epoch = completed rows before this one),
# independent of the Spark side's aggregate formulation.
CKPT_INTENT = (CKPT + ", ck2 AS (SELECT *, coalesce(sum(CASE WHEN status = 'completed' THEN 1 ELSE 0 END) "
               "OVER (PARTITION BY strategy ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
               "AS epoch FROM ck), ck3 AS (SELECT *, row_number() OVER (PARTITION BY strategy, epoch "
               "ORDER BY seq DESC) AS rn FROM ck2), state AS (SELECT seq, strategy, status, cursor, "
               "events_count, metadata, updated_at FROM ck3 WHERE rn = 1)")

HB = ("hb AS (SELECT 'w' || CAST(user_id % 6 AS VARCHAR) AS name, "
      "1000000000000 - (user_id % 6) * 13000 - (event_id % 5) * 100 AS last_progress_ms, "
      "event_id AS fetched FROM ev)")
HEALTH = (HB + ", health AS (SELECT name, last_progress_ms, fetched, 1000000000000 - last_progress_ms AS age_ms, "
          "CASE WHEN 1000000000000 - last_progress_ms > 60000 THEN 'dead' "
          "WHEN 1000000000000 - last_progress_ms > 30000 THEN 'stuck' ELSE 'active' END AS state FROM ("
          "SELECT name, max(last_progress_ms) AS last_progress_ms, arg_max(fetched, [last_progress_ms, fetched]) AS fetched "
          "FROM hb GROUP BY name))")

MD5 = "md5(id)"
UUID = (f"substr({MD5},1,8) || '-' || substr({MD5},9,4) || '-' || substr({MD5},13,4) || '-' || "
        f"substr({MD5},17,4) || '-' || substr({MD5},21,12)")
BAD_UUID = (f"substr({MD5},1,8) || '-' || substr({MD5},9,4) || '-' || substr({MD5},13,4) || '-' || "
            f"substr({MD5},17,4) || '-' || substr({MD5},21,11) || 'g'")
FMT = (f"fs AS (SELECT event_id, id AS event_id_text, "
       f"to_base64(encode(CAST(ms AS VARCHAR) || ':' || CAST(event_id AS VARCHAR))) AS cursor, "
       f"CASE WHEN event_id % 9 = 4 THEN {BAD_UUID} ELSE {UUID} END AS uuid, "
       f"'evt_' || id AS name FROM ev)")


def fmt_class(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN regexp_full_match({x}, '{K.BASE64_PATTERN[1:-1]}') THEN 'base64' "
            f"WHEN regexp_full_match({x}, '{K.NUMERIC_PATTERN[1:-1]}') THEN 'numeric' "
            f"WHEN regexp_full_match({x}, '{K.UUID_LOOSE_PATTERN[1:-1]}') THEN 'uuid' "
            f"ELSE 'opaque' END")


def first_present(j: str, fields) -> str:
    """JSON text of the first candidate present and not null."""
    whens = " ".join(f"WHEN json_type({j}, '{_path(f)}') IS NOT NULL AND json_type({j}, '{_path(f)}') <> 'NULL' "
                     f"THEN json_extract({j}, '{_path(f)}')" for f in fields)
    return f"(CASE {whens} END)"


def ts_class(t: str) -> str:
    s = f"json_extract_string({t}, '$')"
    d = f"TRY_CAST({s} AS DOUBLE)"
    return (f"(CASE WHEN {t} IS NULL THEN 'none' "
            f"WHEN json_type({t}) = 'VARCHAR' AND regexp_matches({s}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN 'iso' "
            f"WHEN json_type({t}) IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND {d} > 1000000000 AND {d} < 2000000000 "
            f"THEN 'unix_s' "
            f"WHEN json_type({t}) IN ('BIGINT', 'UBIGINT', 'DOUBLE') AND {d} > 1000000000000 THEN 'unix_ms' "
            f"ELSE 'unknown' END)")


def sql_regex(p: str) -> str:
    return p.replace("'", "''")


ORACLE_SQL: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    assert name in Q.QUERIES, name
    ORACLE_SQL[name] = text


sql("completeness_by_type", f"""WITH {SLICE},
e AS (SELECT event_type, count(*) AS expected FROM ev GROUP BY 1),
a AS (SELECT event_type, count(*) AS loaded FROM loaded GROUP BY 1)
SELECT coalesce(e.event_type, a.event_type) AS event_type, coalesce(expected, 0) AS expected,
       coalesce(loaded, 0) AS loaded, coalesce(expected, 0) - coalesce(loaded, 0) AS missing
FROM e FULL OUTER JOIN a ON e.event_type = a.event_type""")

sql("idempotent_load", f"WITH {SLICE} SELECT id FROM new")

sql("idempotent_load_counts", f"""WITH {SLICE}
SELECT count(*) AS offered, count(DISTINCT id) AS offered_distinct,
       (SELECT count(*) FROM new) AS inserted, count(*) - (SELECT count(*) FROM new) AS rejected
FROM src""")

sql("combined_sources", f"WITH {SLICE} SELECT id, count(*) AS deliveries FROM src GROUP BY id")

sql("first_wins_load", f"""WITH {DELIVERIES}
SELECT id, arg_min(strategy, seq) AS strategy, arg_min(payload, seq) AS payload FROM deliv
WHERE id NOT IN (SELECT id FROM dtgt) GROUP BY id""")

sql("duplicate_rate", f"""WITH {DELIVERIES},
w AS (SELECT id, arg_min(strategy, seq) AS strategy FROM deliv GROUP BY id),
ins AS (SELECT strategy, count(*) AS inserted FROM w WHERE id NOT IN (SELECT id FROM dtgt) GROUP BY 1),
off AS (SELECT strategy, count(*) AS offered FROM deliv GROUP BY 1)
SELECT off.strategy, offered, coalesce(inserted, 0) AS inserted, offered - coalesce(inserted, 0) AS rejected
FROM off LEFT JOIN ins ON off.strategy = ins.strategy""")

sql("known_duplicates", f"""WITH {DELIVERIES}
SELECT strategy, count(*) AS known_rows, count(DISTINCT id) AS known_ids FROM deliv
WHERE id IN (SELECT id FROM dtgt) GROUP BY strategy""")

sql("offered_vs_distinct", f"""WITH {DELIVERIES}
SELECT count(*) AS offered, count(DISTINCT id) AS distinct_ids, count(*) - count(DISTINCT id) AS repeats
FROM deliv""")

sql("source_overlap", f"""WITH {DELIVERIES},
m AS (SELECT id, bit_or(CASE strategy WHEN 'feed' THEN 1 WHEN 'cursor-chain' THEN 2 ELSE 4 END) AS mask
      FROM deliv GROUP BY id)
SELECT concat_ws('+', CASE WHEN mask & 1 <> 0 THEN 'feed' END, CASE WHEN mask & 2 <> 0 THEN 'cursor-chain' END,
                 CASE WHEN mask & 4 <> 0 THEN 'type-worker' END) AS sources, count(*) AS n_ids
FROM m GROUP BY 1""")

sql("capped_load", f"""WITH {DELIVERIES},
f AS (SELECT id, min(seq) AS s FROM deliv GROUP BY id)
SELECT id FROM (SELECT id, row_number() OVER (ORDER BY s, id) AS r FROM f) WHERE r <= (SELECT n FROM n) // 2""")

sql("bulk_lookup_found", f"""WITH {EV}, asked AS (SELECT CAST(event_id * 3 AS VARCHAR) AS id FROM ev)
SELECT id, event_id, event_type FROM ev WHERE id IN (SELECT id FROM asked)""")

sql("bulk_lookup_missing", f"""WITH {EV}, asked AS (SELECT CAST(event_id * 3 AS VARCHAR) AS id FROM ev)
SELECT DISTINCT id FROM asked WHERE id NOT IN (SELECT id FROM ev)""")

sql("exact_count", f"WITH {SLICE} SELECT count(*) AS n FROM loaded")

sql("shortfall", f"""WITH {SLICE}
SELECT n AS expected, (SELECT count(*) FROM loaded) AS loaded, n - (SELECT count(*) FROM loaded) AS missing,
       CASE WHEN n - (SELECT count(*) FROM loaded) <= 0 THEN 'complete' ELSE 'retry' END AS decision
FROM n""")

sql("progress_summary", f"""WITH {SLICE},
s AS (SELECT (SELECT count(*) FROM loaded) AS l, (SELECT count(*) FROM src) AS o,
             greatest((max(ms) - min(ms)) / 1000.0, 1.0) AS el FROM ev)
SELECT e AS expected, l AS loaded, o AS offered, l * 100.0 / e AS pct, l / el AS rate,
       CASE WHEN l / el > 0 THEN (e - l) / (l / el) / 60.0 END AS eta_min, o - l AS lag
FROM (SELECT *, (SELECT n FROM n) AS e FROM s)""")

sql("time_gaps", f"""WITH {SLICE},
e AS (SELECT ms // {Q.HOUR_MS} AS bucket, count(*) AS expected FROM ev GROUP BY 1),
a AS (SELECT ms // {Q.HOUR_MS} AS bucket, count(*) AS loaded FROM loaded GROUP BY 1),
spine AS (SELECT unnest(range((SELECT min(bucket) FROM e), (SELECT max(bucket) FROM e) + 1)) AS bucket)
SELECT spine.bucket, spine.bucket * {Q.HOUR_MS} AS bucket_start_ms, coalesce(expected, 0) AS expected,
       coalesce(loaded, 0) AS loaded, coalesce(expected, 0) - coalesce(loaded, 0) AS missing
FROM spine LEFT JOIN e ON spine.bucket = e.bucket LEFT JOIN a ON spine.bucket = a.bucket
WHERE coalesce(expected, 0) - coalesce(loaded, 0) > 0""")

sql("gap_ranges", f"""WITH {SLICE},
e AS (SELECT ms // {Q.HOUR_MS} AS bucket, count(*) AS expected FROM ev GROUP BY 1),
a AS (SELECT ms // {Q.HOUR_MS} AS bucket, count(*) AS loaded FROM loaded GROUP BY 1),
g AS (SELECT e.bucket, expected - coalesce(loaded, 0) AS missing FROM e LEFT JOIN a ON e.bucket = a.bucket
      WHERE expected - coalesce(loaded, 0) > 0),
i AS (SELECT *, bucket - row_number() OVER (ORDER BY bucket) AS island FROM g)
SELECT min(bucket) * {Q.HOUR_MS} AS since_ms, (max(bucket) + 1) * {Q.HOUR_MS} AS until_ms, count(*) AS buckets,
       CAST(sum(missing) AS BIGINT) AS missing FROM i GROUP BY island""")

sql("type_distribution", f"""WITH {EV}
SELECT event_type, count(*) AS n, count(*) / (SELECT count(*) FROM ev) AS share FROM ev GROUP BY 1""")

sql("entity_counts", f"""WITH {EV}
SELECT count(*) AS events, count(DISTINCT user_id) AS users,
       count(DISTINCT (user_id, ms // 1800000)) AS sessions, count(DISTINCT event_type) AS types FROM ev""")

# ------------------------------------------------------------------- ids
sql("extract_id", f"""WITH {EV}, {RAW}
SELECT event_id, {jid('json')} AS id, {jpick_field('json')} AS field FROM raw""")

sql("valid_ids", f"""WITH {EV}, {RAW}, x AS (SELECT event_id, {jid('json')} AS id FROM raw)
SELECT event_id, id FROM x WHERE {valid('id')}""")

sql("quarantine_ids", f"""WITH {EV}, {RAW},
x AS (SELECT event_id, {jpick_kind('json')} AS kind, {jid('json')} AS id, json_valid(json) AS ok FROM raw)
SELECT event_id, CASE WHEN NOT ok THEN 'unparsable' WHEN kind IN ('object', 'array') THEN 'object_id'
                      WHEN id IS NULL THEN 'no_id' WHEN id IN ('undefined', 'null') THEN 'sentinel' END AS reason
FROM x WHERE NOT ok OR kind IN ('object', 'array') OR id IS NULL OR id IN ('undefined', 'null')""")

sql("uuid_check", f"""WITH {EV}, {FMT}
SELECT coalesce(regexp_full_match(uuid, '{K.UUID_STRICT_PATTERN[1:-1]}'), false) AS is_valid, count(*) AS n_rows
FROM fs GROUP BY 1""")

sql("string_format_profile", f"""WITH {EV}, {FMT},
u AS (SELECT 'event_id_text' AS "column", {fmt_class('event_id_text')} AS format FROM fs
      UNION ALL SELECT 'cursor', {fmt_class('cursor')} FROM fs
      UNION ALL SELECT 'uuid', {fmt_class('uuid')} FROM fs
      UNION ALL SELECT 'name', {fmt_class('name')} FROM fs)
SELECT "column", format, count(*) AS n_rows FROM u GROUP BY 1, 2""")

# ------------------------------------------------------------- profiling
_TM = " OR ".join(f"coalesce(json_extract_string(json, '$.{f}') = event_type, false)"
                  for f in K.TYPE_FIELDS)
sql("type_filter_check", f"""WITH {EV}, {RAW}
SELECT event_type AS requested_type, count(*) AS n_rows, count(*) FILTER (WHERE {_TM}) AS n_matching,
       bool_and({_TM}) AS all_match FROM raw GROUP BY 1""")

_T = first_present("json", K.TIME_FIELDS_REPORT)
sql("ts_format_profile", f"""WITH {EV}, {RAW}, t AS (SELECT {_T} AS t FROM raw)
SELECT {ts_class('t')} AS format, count(*) AS n_rows FROM t GROUP BY 1""")

sql("ts_normalised", f"""WITH {EV}, {RAW}, t AS (SELECT event_id, {_T} AS t FROM raw),
c AS (SELECT event_id, t, {ts_class('t')} AS format FROM t)
SELECT event_id, format,
  CASE format WHEN 'iso' THEN epoch_us(CAST(json_extract_string(t, '$') AS TIMESTAMPTZ)) // 1000
              WHEN 'unix_s' THEN CAST(TRY_CAST(json_extract_string(t, '$') AS DOUBLE) * 1000 AS BIGINT)
              WHEN 'unix_ms' THEN CAST(TRY_CAST(json_extract_string(t, '$') AS DOUBLE) AS BIGINT) END AS norm_ms
FROM c""")

sql("field_type_profile", f"""WITH {EV}, {RAW},
kv AS (SELECT event_id, k AS field, json_extract(json, '$."' || k || '"') AS val
       FROM raw, unnest(json_keys(json)) AS u(k)),
t AS (SELECT event_id, field, val, {jkind('val', '$')} AS kind FROM kv)
SELECT field, kind, count(*) AS n_rows,
       CAST(max(CASE WHEN kind = 'array' THEN json_array_length(val) END) AS INTEGER) AS max_array_len,
       arg_min(substr(CASE WHEN kind = 'null' THEN 'null' WHEN kind IN ('object', 'array') THEN CAST(val AS VARCHAR)
                           ELSE json_extract_string(val, '$') END, 1, 100), event_id) AS preview
FROM t GROUP BY 1, 2""")

sql("schema_variants", f"""WITH {EV}, {RAW}
SELECT array_to_string(list_sort(json_keys(json)), ',') AS key_set, count(*) AS n_rows FROM raw GROUP BY 1""")

_PRES = []
for _fam, _fields in (("id", K.ID_FIELDS), ("time", K.TIME_FIELDS_REPORT)):
    for _pos, _f in enumerate(_fields):
        _PRES.append(f"SELECT '{_fam}' AS family, {_pos} AS position, '{_f}' AS field, "
                     f"count(*) FILTER (WHERE json_type(json, '$.{_f}') IS NOT NULL "
                     f"AND json_type(json, '$.{_f}') <> 'NULL') AS n_present FROM raw")
sql("candidate_field_presence", f"""WITH {EV}, {RAW}, p AS ({' UNION ALL '.join(_PRES)}),
f AS (SELECT family, min(position) AS fp FROM p WHERE n_present > 0 GROUP BY 1)
SELECT p.family, p.position, p.field, p.n_present, coalesce(p.position = f.fp, false) AS is_used
FROM p LEFT JOIN f ON p.family = f.family""")

_PROBE = [f"SELECT '{fam}' AS family, {pos} AS position, '{f}' AS field, count(*) FILTER (WHERE json_type(json, '$.{f}') IS NOT NULL "
          f"AND json_type(json, '$.{f}') <> 'NULL') AS n_present FROM raw"
          for fam, fields in (("id", K.ID_FIELDS_PROBE), ("time", K.TIME_FIELDS_PROBE)) for pos, f in enumerate(fields)]
sql("probe_field_presence", f"""WITH {EV}, {RAW}, p AS ({' UNION ALL '.join(_PROBE)}),
f AS (SELECT family, min(position) AS fp FROM p WHERE n_present > 0 GROUP BY 1)
SELECT p.family, p.position, p.field, p.n_present, coalesce(p.position = f.fp, false) AS is_used
FROM p LEFT JOIN f ON p.family = f.family""")

# ----------------------------------------------------------------- scans
sql("time_range", f"WITH {EV} SELECT min(ms) AS min_ms, max(ms) AS max_ms FROM ev")

sql("time_range_filter", f"""WITH {EV}
SELECT event_id, ms FROM ev
WHERE ts >= make_timestamp({Q.FILTER_SINCE_MS} * 1000) AND ts < make_timestamp({Q.FILTER_UNTIL_MS} * 1000)""")

_SL = (f"b AS (SELECT min(ms) AS lo, max(ms) AS hi, greatest(CAST(ceil((max(ms) - min(ms)) / {K.TIME_SLICES}.0) AS BIGINT), 1) AS w FROM ev), "
       f"sl AS (SELECT CAST(s AS INTEGER) AS slice, lo + s * w AS since_ms, least(lo + (s + 1) * w, hi + 1) AS until_ms "
       f"FROM (SELECT unnest(range({K.TIME_SLICES})) AS s, (SELECT lo FROM b) AS lo, (SELECT w FROM b) AS w, "
       f"(SELECT hi FROM b) AS hi))")
sql("scan_time_slices", f"""WITH {EV}, {_SL},
c AS (SELECT CAST(least(floor((ms - (SELECT lo FROM b)) / (SELECT w FROM b)), {K.TIME_SLICES - 1}) AS INTEGER)
             AS slice, count(*) AS n_rows FROM ev GROUP BY 1)
SELECT sl.slice, since_ms, until_ms, coalesce(n_rows, 0) AS n_rows FROM sl LEFT JOIN c ON sl.slice = c.slice""")

sql("range_join_slices", f"""WITH {EV}, {_SL}
SELECT sl.slice, count(*) AS n_rows FROM ev LEFT JOIN sl ON ev.ms >= sl.since_ms AND ev.ms < sl.until_ms
GROUP BY 1""")

sql("scan_by_type", f"""WITH {EV}
SELECT event_type, count(*) AS n_rows, count(DISTINCT id) AS n_ids FROM ev
WHERE event_type IN {tuple(Q.TYPES_SCANNED)} GROUP BY 1""")

sql("scan_offset_ranges", f"""WITH {EV}, {N},
i AS (SELECT *, row_number() OVER (ORDER BY ts DESC, event_id DESC) - 1 AS idx FROM ev),
r AS (SELECT *, CAST(least(floor(idx / greatest(ceil((SELECT n FROM n) / {Q.N_RANGES}.0), 1)), {Q.N_RANGES - 1})
             AS INTEGER) AS range_no FROM i)
SELECT range_no, min(idx) AS start_offset, max(idx) + 1 AS end_offset, count(*) AS n_rows,
       arg_min(event_id, idx) AS first_event_id, arg_max(event_id, idx) AS last_event_id FROM r GROUP BY 1""")

sql("keyset_pages", f"""WITH {EV},
i AS (SELECT *, (row_number() OVER (ORDER BY ts DESC, event_id DESC) - 1) AS idx FROM ev),
p AS (SELECT *, idx // {PAGE_SIZE} AS page_no FROM i)
SELECT page_no, count(*) AS n_rows, arg_min(event_id, idx) AS first_key, arg_max(event_id, idx) AS last_key,
       arg_max(to_base64(encode(CAST(ms AS VARCHAR) || ':' || CAST(event_id AS VARCHAR))), idx) AS next_cursor,
       page_no < (SELECT max(page_no) FROM p) AS has_more
FROM p GROUP BY page_no""")

sql("keyset_page_after", f"""WITH {EV}
SELECT event_id, ms FROM ev WHERE ms < {Q.CURSOR_MS} OR (ms = {Q.CURSOR_MS} AND event_id < {Q.CURSOR_KEY})
ORDER BY ms DESC, event_id DESC LIMIT {PAGE_SIZE}""")

sql("keyset_seek_stored", f"""WITH {EV}
SELECT event_id, ms FROM ev WHERE ms < {Q.CURSOR_MS} OR (ms = {Q.CURSOR_MS} AND event_id < {Q.CURSOR_KEY})
ORDER BY ms DESC, event_id DESC LIMIT {PAGE_SIZE}""")

sql("range_join_uneven", f"""WITH {EV}, iv AS (
  SELECT batch AS slice, min(ms) AS since_ms, min(ms) + 1000 * (1 + batch % 97) * (1 + 900 * CAST(batch % 41 = 0 AS INTEGER)) AS until_ms
  FROM (SELECT event_id // 20 AS batch, ms FROM ev) GROUP BY batch),
hot AS (SELECT CASE WHEN event_id % 3 = 0 THEN (SELECT min(ms) FROM ev) ELSE ms END AS ms, event_id FROM ev)
SELECT slice, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS key_sum
FROM hot LEFT JOIN iv ON hot.ms >= iv.since_ms AND hot.ms < iv.until_ms GROUP BY 1""")

sql("staggered_chain_overlap", f"""WITH {EV},
p AS (SELECT (row_number() OVER (ORDER BY ts DESC, event_id DESC) - 1) // {PAGE_SIZE} AS page_no FROM ev),
d AS (SELECT 'chain-' || CAST(k AS VARCHAR) AS source, page_no
      FROM (SELECT page_no, unnest(range(least(page_no, {Q.N_CHAINS - 1}) + 1)) AS k FROM p)
      UNION ALL SELECT 'seed', page_no FROM p WHERE page_no < {Q.N_CHAINS - 1})
SELECT source, count(*) AS n_rows, count(DISTINCT page_no) AS n_pages, min(page_no) AS first_page
FROM d GROUP BY 1""")

sql("project_ids", "SELECT CAST(event_id AS VARCHAR) AS id FROM events")

sql("export_batches", f"""WITH {EV},
i AS (SELECT id, (row_number() OVER (ORDER BY id) - 1) // {Q.EXPORT_CHUNK} AS batch_no FROM ev)
SELECT batch_no, count(*) AS n_ids, min(id) AS first_id, max(id) AS last_id FROM i GROUP BY 1""")

# --------------------------------------------------------------- sources
_PAGE_ROWS = (f"WITH {EV}, {RAW}, {PAGED}, "
              f"x AS (SELECT pg.*, {jid('json')} AS id2, pgc.cur FROM pg JOIN pgc USING (page_no))")
sql("src_paged_flat", f"""{_PAGE_ROWS}
SELECT id2 AS id, CASE WHEN page_no % 2 = 1 THEN page_no < last_page END AS has_more,
       CASE WHEN page_no % 2 = 1 AND page_no < last_page THEN cur END AS next_cursor
FROM x WHERE {valid('id2')}""")

sql("src_paged_nested", f"""{_PAGE_ROWS}
SELECT id2 AS id, page_no < last_page AS has_more, CASE WHEN page_no < last_page THEN cur END AS next_cursor
FROM x WHERE {valid('id2')}""")

sql("src_dump_json", f"""WITH {EV}, {RAW}, {PAGED},
x AS (SELECT page_no, CASE WHEN page_no % 4 = 2 THEN
        (CASE WHEN event_id % 50 = 7 THEN 'null' ELSE id END) ELSE {jid('json')} END AS id2 FROM pg)
SELECT page_no, id2 AS id FROM x WHERE {valid('id2')}""")

sql("dump_split", f"""WITH {EV}, {RAW},
x AS (SELECT CAST(event_id % 4 AS INTEGER) AS form,
             row_number() OVER (PARTITION BY event_id % 4 ORDER BY event_id) - 1 AS element, event_id % 50 = 13 AS bad,
             CASE WHEN event_id % 4 = 2 THEN (CASE WHEN event_id % 50 = 7 THEN 'null' ELSE id END) ELSE {jid('json')} END AS id2
      FROM raw)
SELECT form, element, CASE WHEN NOT bad THEN id2 END AS id, CASE WHEN bad THEN 'not parsed' END AS reason
FROM x WHERE bad OR {valid('id2')}""")

_LOST = "CASE page_no % 5 WHEN 2 THEN 'not parsed' WHEN 4 THEN 'no array' END"
_ENVELOPE = """length('{"data":[') + sum(length(json)) + count(*) - 1 + CASE WHEN page_no % 2 = 0
  THEN length('],"pagination":{"hasMore":,"nextCursor":,"cursorExpiresIn":119}}') ELSE length('],"hasMore":,"nextCursor":}') END
  + CASE WHEN page_no < any_value(last_page) THEN length('true""') + length(any_value(cur)) ELSE length('falsenull') END"""
sql("page_quarantine", f"""WITH {EV}, {RAW}, {PAGED}
SELECT page_no, {_LOST} AS reason, CAST(CASE WHEN page_no % 5 = 4 THEN length('{{"hasMore":false}}') ELSE {_ENVELOPE} - 9 END AS INTEGER) AS n_chars
FROM pg JOIN pgc USING (page_no) WHERE page_no % 5 IN (2, 4) GROUP BY page_no""")

sql("dump_quarantine", f"""WITH {EV}, {RAW}, {PAGED}
SELECT DISTINCT page_no, {_LOST} AS reason FROM pg WHERE page_no % 5 IN (2, 4)""")

sql("load_with_rejects", f"""{_PAGE_ROWS}
SELECT page_no, CASE WHEN page_no % 5 IN (2, 4) THEN 0 ELSE count(*) FILTER (WHERE {valid('id2')}) END AS n_rows, {_LOST} AS reason
FROM x GROUP BY page_no""")

_BARE = "(length(t) > 5 AND length(t) < 200)"
sql("src_ndjson_lenient", f"""WITH {EV}, {RAW},
l AS (SELECT event_id, json, CASE WHEN event_id % 50 = 9 THEN '123456789'
        WHEN event_id % 50 = 19 THEN '{{bad json ' || id WHEN event_id % 50 = 29 THEN 'ab'
        WHEN event_id % 50 = 39 THEN '' WHEN event_id % 50 = 49 THEN 'true'
        WHEN event_id % 5 = 1 THEN '"' || id || '"' WHEN event_id % 5 = 2 THEN '  evt-' || id || '-x '
        ELSE json END AS line FROM raw),
t AS (SELECT event_id, line, trim(line) AS t, json_valid(line) AS ok FROM l WHERE trim(line) <> ''),
x AS (SELECT event_id, CASE WHEN NOT ok THEN CASE WHEN {_BARE} THEN t END
        WHEN json_type(line) = 'VARCHAR' THEN json_extract_string(line, '$')
        WHEN json_type(line) = 'OBJECT' THEN {jid('line')} END AS id FROM t)
SELECT event_id, id FROM x WHERE {valid('id')}""")

sql("src_ndjson_strict", f"""WITH {EV}, {RAW}, x AS (SELECT event_id, {jid('json')} AS id FROM raw)
SELECT event_id, id FROM x WHERE {valid('id')}""")

_GATE = " OR ".join(jtruthy("d", f"$.{g}") for g in K.SSE_ID_GATE_FIELDS)
sql("src_sse", f"""WITH {EV}, {RAW},
l AS (SELECT event_id, id, json, CASE WHEN event_id % 50 = 11 THEN 'data: {{broken ' || id
        WHEN event_id % 50 = 21 THEN 'data:' WHEN event_id % 50 = 31 THEN 'data: abc'
        WHEN event_id % 6 = 0 THEN 'data: ' || json WHEN event_id % 6 = 1 THEN 'data: "' || id || '"'
        WHEN event_id % 6 = 2 THEN 'data: [' || json || ']' WHEN event_id % 6 = 3 THEN 'event: message'
        WHEN event_id % 6 = 4 THEN 'data: evt-' || id || '-sse' ELSE 'data: [DONE]' END AS line FROM raw),
f AS (SELECT event_id, trim(substr(line, 6)) AS d FROM l WHERE starts_with(line, 'data:')),
g AS (SELECT event_id, d, json_valid(d) AS ok FROM f WHERE d <> '' AND d <> '[DONE]'),
x AS (SELECT event_id, CASE WHEN NOT ok THEN CASE WHEN length(d) > 5 AND length(d) < 200 AND NOT contains(d, '{{')
                                                  THEN d END
        WHEN json_type(d) = 'VARCHAR' THEN json_extract_string(d, '$')
        WHEN json_type(d) = 'ARRAY' THEN {elem_id("json_extract(d, '$[0]')")}
        WHEN json_type(d) = 'OBJECT' AND ({_GATE}) THEN {jid('d')} END AS id FROM g)
SELECT event_id, id FROM x WHERE {valid('id')}""")

sql("src_csv", f"""WITH {EV}
SELECT id FROM (SELECT CASE WHEN event_id % 50 = 7 THEN 'undefined' WHEN event_id % 50 = 17 THEN NULL
                            ELSE 'e' || id END AS id FROM ev) WHERE {valid('id')}""")

sql("src_csv_mixed", f"""WITH {EV}
SELECT shape, id FROM (SELECT CAST(event_id % 4 AS INTEGER) AS shape, CASE WHEN event_id % 50 = 7 THEN 'undefined' WHEN event_id % 50 = 17 THEN NULL
                                  ELSE 'e' || id END AS id FROM ev WHERE event_id % 4 <> 2) WHERE {valid('id')}""")

sql("journal_replay", f"""WITH {DELIVERIES},
lines AS (SELECT id, event_id FROM deliv UNION ALL SELECT '', event_id FROM deliv WHERE event_id % 13 = 0),
ids AS (SELECT id FROM lines WHERE id <> '')
SELECT (SELECT count(*) FROM lines) AS lines, (SELECT count(*) FROM ids) AS ids,
       (SELECT count(DISTINCT id) FROM ids WHERE id NOT IN (SELECT id FROM dtgt)) AS recovered""")

sql("stats_doc_rows", f"""WITH {EV}
SELECT 'counts' AS section, 'events' AS name, count(*) AS count, CAST(NULL AS VARCHAR) AS value FROM ev
UNION ALL SELECT 'counts', 'users', count(DISTINCT user_id), NULL FROM ev
UNION ALL SELECT 'counts', 'types', count(DISTINCT event_type), NULL FROM ev
UNION ALL SELECT 'eventTypes', event_type, count(*), NULL FROM ev GROUP BY event_type
UNION ALL SELECT 'deviceTypes', ({_list(K.DEVICE_TYPES)})[user_id % 3 + 1], count(*), NULL FROM ev GROUP BY 2
UNION ALL SELECT 'shards', CAST(user_id % 5 AS VARCHAR), count(*), NULL FROM ev GROUP BY 2
UNION ALL SELECT 'total', NULL, NULL, '{{"n":' || count(*) || '}}' FROM ev
UNION ALL SELECT 'cache', 'hits', NULL, '0' UNION ALL SELECT 'unexpected', 'build', NULL, '"v2"'
UNION ALL SELECT 'rejected', NULL, NULL, 'no json'""")

sql("export_ids", f"WITH {SLICE} SELECT id FROM loaded")

sql("export_gate", """SELECT count(*) AS exact, count(*) AS exported, count(*) AS required, 'exported' AS status, true AS published FROM events
UNION ALL SELECT count(*), 0, count(*) + 1, 'refused_count', false FROM events
UNION ALL SELECT count(*), count(*) + count(*) FILTER (WHERE event_id % 97 = 0), count(*), 'refused_mismatch', false FROM events""")

# ------------------------------------------------------------- page text
SCRIPTED = """scripted AS (SELECT page_id, coalesce(html, '') || '<script src="/a' || page_id || '.js"></script><script src="/x.css"></script>'
  || '<script type="module" src="/assets/b"></script><script src="c.js"></script><script src="/d.js"></script>'
  || '<script>fetch("/api/v1/pages/' || page_id || '"); fetch( ''https://x.example/' || page_id || ''' ); const p = "/api/v1/pages/'
  || page_id || '", q = "/internal/p/' || page_id || '", r = ''/internal/p/' || page_id
  || ''', h = {"Page-Token": 1, ''Content-Type'': 2, "lower-case": 3};</script>' AS html FROM pages)"""
sql("page_script_srcs", f"""WITH {SCRIPTED}, m AS (SELECT page_id, list_slice(list_filter(
    regexp_extract_all(html, '{sql_regex(K.SCRIPT_SRC_PATTERN)}', 1),
    lambda s: suffix(s, '.js') OR contains(s, 'assets/')), 1, {K.SCRIPT_MAX}) AS a FROM scripted)
SELECT page_id, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS pos, unnest(a) AS src FROM m""")

sql("page_href_links", f"""WITH m AS (SELECT page_id, regexp_extract_all(html, '{sql_regex(Q.HREF_PATTERN)}', 1) AS a
    FROM pages)
SELECT page_id, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS pos, unnest(a) AS src FROM m""")

sql("page_call_urls", f"""WITH {SCRIPTED}, m AS (SELECT page_id, regexp_extract_all(html, '{sql_regex(K.FETCH_URL_PATTERN)}', 1) AS a
    FROM scripted)
SELECT page_id, pos, url, starts_with(url, '/api/') OR starts_with(url, '/internal/') AS is_endpoint
FROM (SELECT page_id, CAST(generate_subscripts(a, 1) - 1 AS INTEGER) AS pos, unnest(a) AS url FROM m)""")

sql("page_path_literals", f"""WITH {SCRIPTED}, m AS (SELECT page_id,
    list_distinct(regexp_extract_all(html, '{sql_regex(K.PATH_LITERAL_PATTERN)}', 1)) AS p,
    list_filter(regexp_extract_all(html, '{sql_regex(K.FETCH_URL_PATTERN)}', 1),
                lambda u: starts_with(u, '/api/') OR starts_with(u, '/internal/')) AS f FROM scripted)
SELECT page_id, unnest(list_filter(p, lambda x: NOT list_contains(f, x))) AS path FROM m""")

sql("page_query_params", f"""SELECT DISTINCT page_id, unnest(regexp_extract_all(url, '{sql_regex(K.QUERY_PARAM_PATTERN)}', 1)) AS param
FROM pages""")

sql("page_header_names", f"""WITH {SCRIPTED}
SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '{sql_regex(K.HEADER_NAME_PATTERN)}', 1)) AS header
FROM scripted""")

sql("link_rel_extract", f"""WITH {EV},
l AS (SELECT event_id, '<https://feed.example/' || event_type || '/' || id || '>; rel="' ||
      (['stream','export','bulk','download','next'])[event_id % 5 + 1] || '"' AS link FROM ev)
SELECT event_id, CASE WHEN regexp_matches(link, '{sql_regex(K.LINK_REL_PATTERN)}')
                      THEN regexp_extract(link, '{sql_regex(K.LINK_REL_PATTERN)}', 1) END AS url FROM l""")

sql("request_outcome_rollup", f"""WITH {EV},
l AS (SELECT CASE WHEN event_id % 2 = 0 THEN 'header' ELSE 'query' END AS channel,
             ([200, 200, 429, 500, 404, 401])[event_id % 6 + 1] AS status FROM ev)
SELECT channel, CASE WHEN status IN (401, 403) THEN 'auth' WHEN status = 429 THEN 'throttled'
                     WHEN status >= 500 THEN 'server' WHEN status >= 400 THEN 'client' ELSE 'ok' END AS outcome,
       count(*) AS n FROM l GROUP BY 1, 2""")

# ------------------------------------------------------------ operations
sql("checkpoint_state", f"WITH {EV}, {CKPT_INTENT} SELECT * FROM state")

sql("checkpoint_state_as_written", f"""WITH {EV}, {CKPT}
SELECT * FROM ck WHERE status = 'completed'
UNION ALL SELECT * FROM (SELECT * FROM ck WHERE status <> 'completed'
  QUALIFY row_number() OVER (PARTITION BY strategy ORDER BY seq DESC) = 1)""")

sql("latest_checkpoint", f"""WITH {EV}, {CKPT_INTENT}
SELECT * FROM state WHERE status <> 'completed' ORDER BY updated_at DESC, seq DESC LIMIT 1""")

_CUM = (f"c AS (SELECT worker, batch, events, CAST(sum(events) OVER (PARTITION BY worker ORDER BY batch "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS fetched FROM b)")
sql("milestones", f"""WITH {EV}, {BATCHES}, {_CUM}
SELECT worker, batch, events, fetched FROM c WHERE fetched % {Q.MILESTONE_EVERY} < events""")

sql("milestones_exact", f"""WITH {EV}, {BATCHES}, {_CUM}
SELECT worker, batch, events, fetched FROM c WHERE fetched % {Q.MILESTONE_EVERY} = 0""")

sql("running_totals", f"""WITH {EV}, {BATCHES}
SELECT strategy, batch,
  CAST(sum(events) OVER (PARTITION BY strategy ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS BIGINT) AS offered_total,
  CAST(sum(inserted) OVER (PARTITION BY strategy ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
       AS BIGINT) AS inserted_total
FROM b""")

_RATE = (f"nw AS (SELECT max(ts_ms) + 1000 AS now FROM b), "
         f"rw AS (SELECT strategy, CAST(sum(events) AS BIGINT) AS events_in_window, "
         f"CASE WHEN (max(now) - min(ts_ms)) / 1000.0 > 0 THEN sum(events) / ((max(now) - min(ts_ms)) / 1000.0) "
         f"ELSE 0.0 END AS rate FROM (SELECT *, (SELECT now FROM nw) AS now FROM b) WHERE ts_ms >= now - {Q.DAY_MS} "
         f"GROUP BY strategy), "
         f"r AS (SELECT s.strategy, coalesce(events_in_window, 0) AS events_in_window, coalesce(rate, 0.0) AS rate "
         f"FROM (SELECT DISTINCT strategy FROM b) s LEFT JOIN rw ON s.strategy = rw.strategy)")
sql("throughput_rate", f"WITH {EV}, {BATCHES}, {_RATE} SELECT strategy, events_in_window, rate FROM r")

sql("best_strategy", f"""WITH {EV}, {BATCHES}, {_RATE},
fs AS (SELECT strategy, min(ts_ms) AS first_seen FROM b GROUP BY 1)
SELECT (SELECT strategy FROM r JOIN fs USING (strategy) WHERE rate > 0 ORDER BY rate DESC, first_seen LIMIT 1)
         AS best_strategy,
       (SELECT max(rate) FROM r WHERE rate > 0) AS best_rate""")

sql("throughput_trend", f"""WITH {EV}, {BATCHES},
h AS (SELECT ts_ms // {Q.TREND_BUCKET_MS} AS bucket, CAST(sum(events) AS BIGINT) AS events FROM b GROUP BY 1),
d AS (SELECT bucket, coalesce(events, 0) AS events
      FROM (SELECT unnest(range((SELECT min(bucket) FROM h), (SELECT max(bucket) FROM h) + 1)) AS bucket) LEFT JOIN h USING (bucket)),
r AS (SELECT bucket, events, events / {Q.TREND_BUCKET_MS / 1000.0} AS rate FROM d),
p AS (SELECT *, lag(rate) OVER (ORDER BY bucket) AS prev_rate FROM r)
SELECT bucket, events, rate, prev_rate,
  CASE WHEN prev_rate > 0 THEN CASE WHEN rate > prev_rate * {K.TREND_UP_RATIO} THEN 'ramp_up'
                                    WHEN rate < prev_rate * {K.TREND_DOWN_RATIO} THEN 'back_off' ELSE 'hold' END END
    AS action FROM p""")

sql("recent_samples", f"""WITH {EV}, {BATCHES}
SELECT batch, ts_ms, events, strategy FROM b ORDER BY ts_ms DESC, batch DESC LIMIT {K.RECENT_SAMPLES}""")

sql("worker_health", f"WITH {EV}, {HEALTH} SELECT * FROM health")

sql("worker_health_counts", f"WITH {EV}, {HEALTH} SELECT state, count(*) AS workers FROM health GROUP BY 1")

# ------------------------------------------------------------- streaming
sql("stream_idempotent_load", f"""WITH {DELIVERIES}
SELECT id FROM dtgt UNION SELECT id FROM deliv""")

sql("stream_dedup_watermark", f"WITH {DELIVERIES} SELECT DISTINCT id FROM deliv")

# six time-ordered chunks, a batch each; the late rows land with the last, when the watermark
# is the newest time of the chunk before the one before
sql("stream_late_rows", f"""WITH {EV},
b AS (SELECT min(ms) AS lo, max(ms) AS hi, (max(ms) - min(ms) + 6) // 6 AS w FROM ev),
c AS (SELECT ms, event_id % 50 = 0 AS late, CASE WHEN event_id % 50 = 0 THEN 5 ELSE (ms - lo) // w END AS chunk FROM ev, b),
d AS (SELECT count(*) AS landed, count(*) FILTER (WHERE late AND (ms // {Q.DAY_MS} + 1) * {Q.DAY_MS} <=
        (SELECT max(ms) FROM c WHERE chunk <= 3)) AS dropped FROM c)
SELECT landed, landed - dropped AS counted, dropped, dropped > 0 AS measured, 6 AS batches FROM d""")

sql("stream_throughput", f"""WITH {EV},
s AS (SELECT (ms // 43200000) * 43200000 AS window_start_ms FROM ev
      UNION ALL SELECT (ms // 43200000) * 43200000 - 43200000 FROM ev)
SELECT window_start_ms, window_start_ms + {Q.DAY_MS} AS window_end_ms, count(*) AS events,
       count(*) / {Q.DAY_MS / 1000.0} AS rate FROM s GROUP BY 1""")

sql("stream_daily_counts", f"""WITH {EV}
SELECT (ms // {Q.DAY_MS}) * {Q.DAY_MS} AS window_start_ms, (ms // {Q.DAY_MS}) * {Q.DAY_MS} + {Q.DAY_MS} AS window_end_ms,
       event_type, count(*) AS events FROM ev GROUP BY 1, 2, 3""")

sql("stream_worker_health", f"WITH {EV}, {HEALTH} SELECT name, state, last_progress_ms, fetched FROM health")

sql("sketch_counts", f"""WITH {DELIVERIES}, a AS (SELECT DISTINCT id, strategy FROM deliv)
SELECT strategy AS source, '' AS other, count(*) AS offered, count(DISTINCT id) AS exact, true AS within FROM deliv GROUP BY 1
UNION ALL SELECT x.strategy, y.strategy, NULL, count(*), true FROM a x JOIN a y USING (id)
WHERE x.strategy < y.strategy GROUP BY 1, 2""")
