"""The same results in plain SQL, computed from the rows of ``events`` and not from the
JSON made of them."""

from __future__ import annotations

from telemill.checks.feeds import BAD_LONG_CELLS, DELIMITED_FAULTS, FAULTS, LONG_ROUTES, MANY_COLUMNS, WIDE_FIELDS

_RULES = " ".join(f"WHEN event_id % {number} = 0 THEN '{kind}'" for number, kind in FAULTS)

# Events with the fault of their payload, and what becomes of it.
FEED = f"""
WITH kinds AS (
  SELECT *, CASE {_RULES} ELSE 'clean' END AS kind FROM events
), feed AS (
  SELECT *,
    kind NOT IN ('bad_json', 'no_fields', 'flat_fields', 'scalar_root', 'empty_list') AS sound,
    kind NOT IN ('bad_json', 'no_fields', 'flat_fields', 'scalar_root', 'empty_list', 'ts_null') AS parsed,
    kind IN ('clean', 'ts_missing', 'id_missing', 'route_missing') AS stored,
    CASE kind WHEN 'route_missing' THEN 'public' ELSE 'telemetry' END AS route_schema,
    CASE kind WHEN 'route_missing' THEN 'example' ELSE event_type END AS route_table,
    CASE kind WHEN 'ts_missing' THEN TIMESTAMP '1970-01-01 08:00:00'
              ELSE date_trunc('second', ts) END AS stamp,
    CASE kind WHEN 'id_missing' THEN 'id' ELSE 'dev-' || user_id END AS device,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_value,
    replace(props, ' ', '') AS props_value
  FROM kinds
)
"""

# Events with the list payload they are in.
LISTS = """
WITH parts AS (
  SELECT *, event_id // 4 AS batch, event_id % 4 AS pos,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_value
  FROM events
), lists AS (
  SELECT *, batch % 17 <> 0 AS aligned, batch % 17 <> 0 AND batch % 10 = 0 AS has_message,
    date_trunc('second', first_value(ts) OVER w) AS first_stamp,
    'dev-' || first_value(user_id) OVER w AS first_device
  FROM parts WINDOW w AS (PARTITION BY batch ORDER BY event_id)
)
"""

# Events with the part of the evolving feed they are in.
EVOLVING = """
WITH ends AS (
  SELECT min(event_id) AS first, (max(event_id) - min(event_id) + 1) // 3 AS third FROM events
), evolving AS (
  SELECT events.*, least((event_id - first) // third, 2) AS part,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_value,
    replace(props, ' ', '') AS props_value
  FROM events, ends
)
"""

# Cells of the object feed in long form.
CELLS = FEED + """
, cells AS (
  SELECT event_id, kind, route_schema, route_table, 'value' AS "column", 'float' AS tag,
    CASE kind WHEN 'bad_cell' THEN 'abc' ELSE CAST(value AS VARCHAR) END AS text FROM feed WHERE parsed
  UNION ALL
  SELECT event_id, kind, route_schema, route_table, 'k', 'int', CAST(k_value AS VARCHAR) FROM feed WHERE parsed
  UNION ALL
  SELECT event_id, kind, route_schema, route_table, 'props', 'json', props_value FROM feed WHERE parsed
  UNION ALL
  SELECT event_id, kind, route_schema, route_table, 'message', 'str', 'err ' || event_id
  FROM feed WHERE parsed AND event_type = 'error'
  UNION ALL
  SELECT event_id, kind, route_schema, route_table, 'level', 'int', CAST(event_id % 5 AS VARCHAR)
  FROM feed WHERE parsed AND event_type = 'error'
  UNION ALL
  SELECT event_id, kind, route_schema, route_table, 'source', 'str', 'TCP'
  FROM feed WHERE parsed AND event_type = 'error'
), typed AS (
  SELECT *, CASE WHEN tag IN ('int', 'float') THEN 'DOUBLE' WHEN tag = 'json' THEN 'JSON'
                 ELSE 'STRING' END AS storage
  FROM cells
)
"""

def _all_tables(where: str = "true", more: str = "") -> str:
    return FEED + f"""
SELECT route_table AS table_name, stamp AS "timestamp", device AS deviceid, value,
  CAST(k_value AS DOUBLE) AS k, props_value AS props, {_MESSAGE} {more}
FROM feed WHERE stored AND {where}
UNION ALL
SELECT 'message', stamp, device, NULL, NULL, NULL, {_MESSAGE} {more}
FROM feed WHERE parsed AND event_type = 'error' AND {where}
"""


def _unparked() -> str:
    return _all_tables() + """
UNION ALL
SELECT 'parked click', NULL, NULL, CAST(count(*) AS DOUBLE), CAST(count(*) AS DOUBLE), NULL, NULL, NULL, NULL
FROM feed WHERE parsed AND route_schema = 'telemetry' AND event_type = 'click'
UNION ALL
SELECT 'left', NULL, NULL, 0, NULL, NULL, NULL, NULL, NULL
"""


_LONG = " ".join(f"WHEN {kind} THEN '{schema}.{table}'" for kind, (schema, table) in LONG_ROUTES.items())

_MESSAGE = """
  CASE event_type WHEN 'error' THEN 'err ' || event_id END AS message,
  CAST(CASE event_type WHEN 'error' THEN event_id % 5 END AS DOUBLE) AS level,
  CASE event_type WHEN 'error' THEN 'TCP' END AS source"""

_REASON = """CASE kind WHEN 'bad_json' THEN 'bad_json' WHEN 'scalar_root' THEN 'bad_payload_type'
            WHEN 'empty_list' THEN 'empty_batch' WHEN 'ts_null' THEN 'null_timestamp'
            WHEN 'bad_cell' THEN 'cast_failed' ELSE 'structure' END"""

# The payloads of the object feed, as far as refused ones have them.
_PAYLOAD = """
CASE kind WHEN 'scalar_root' THEN '5' WHEN 'empty_list' THEN '[]' ELSE
  (CASE kind WHEN 'bad_json' THEN left(whole, length(whole) - 1) ELSE whole END) END"""

_WHOLE = FEED + """, written AS (
  SELECT *, '{' || concat_ws(',',
    CASE kind WHEN 'ts_null' THEN '"timestamp":null' WHEN 'ts_missing' THEN NULL
      ELSE '"timestamp":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"' END,
    CASE WHEN kind <> 'route_missing' THEN '"schema":"telemetry","table":"' || event_type || '"' END,
    CASE WHEN kind <> 'id_missing' THEN '"deviceid":"dev-' || user_id || '"' END,
    '"fields":' || CASE kind WHEN 'no_fields' THEN '{}' WHEN 'flat_fields' THEN '{"value":5,"k":"x"}' ELSE
      '{' || concat_ws(',',
        '"value":{"value":' || CASE kind WHEN 'bad_cell' THEN '"abc"' ELSE CAST(value AS VARCHAR) END
          || ',"type":"float","unit":"mm"}',
        '"k":{"value":' || k_value || ',"type":"int"}',
        '"props":{"value":' || props || ',"type":"json"}',
        CASE event_type WHEN 'error' THEN '"message":{"value":"err ' || event_id || '","type":"str"},"level":{"value":'
          || (event_id % 5) || ',"type":"int"},"source":{"value":"TCP","type":"str"}' END) || '}' END) || '}' AS whole
  FROM feed
)
"""

_TOPIC = "'plant/' || event_type || '/' || (user_id % 4)"

_DELIMITED_RULES = " ".join(f"WHEN event_id // 4 % {number} = 0 THEN '{kind}'" for number, kind in DELIMITED_FAULTS)

_MOVED_BY = """
WITH moved AS (
  SELECT date_trunc('second', {stamp}) AS stamp, user_id, value,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k_value, event_id AS seq
  FROM events
)
"""
_HOURS = _MOVED_BY.format(stamp="ts - to_days(CAST(day(ts) - 1 - event_id % 2 AS INTEGER))")
_MONTHS = _MOVED_BY.format(stamp="ts + to_months(CAST(event_id % 12 AS INTEGER))")

_MOVED = """stamp AS "timestamp", 'dev-' || user_id AS deviceid, value, CAST(k_value AS DOUBLE) AS k"""


def _partitions(moved: str, keys: str) -> str:
    return moved + f"SELECT {_MOVED}, {keys}, CASE seq % 3 WHEN 2 THEN 'third' ELSE 'merged-' END AS ingest_batch FROM moved"


def _read_back(moved: str, start: str, end: str) -> str:
    return moved + f"""
(SELECT 'newest' AS which, {_MOVED} FROM moved ORDER BY stamp DESC, deviceid DESC, value DESC LIMIT 9)
UNION ALL SELECT 'range', {_MOVED} FROM moved WHERE stamp >= TIMESTAMP '{start}' AND stamp < TIMESTAMP '{end}'
"""


ORACLE = {
    "raw_stream_scan": _WHOLE + f"""
SELECT event_id AS seq, {_TOPIC} AS topic, ts AS recv_ts, {_PAYLOAD} AS payload FROM written
""",
    "topic_filter": f"""
SELECT event_id AS seq, {_TOPIC} AS topic FROM events WHERE event_type = 'error' OR user_id % 4 = 0
""",
    "topic_fanout": """
SELECT event_id AS seq, 'plant/#' AS subscription FROM events
UNION ALL SELECT event_id, 'plant/error/+' FROM events WHERE event_type = 'error'
UNION ALL SELECT event_id, 'plant/+/0' FROM events WHERE user_id % 4 = 0
""",
    "table_scan": FEED + """
SELECT stamp AS "timestamp", device AS deviceid, CAST(k_value AS DOUBLE) AS k, props_value AS props, value
FROM feed WHERE stored AND route_schema = 'telemetry' AND route_table = 'click'
""",
    "series_insert": """
SELECT event_id * 10 + n AS id, true AS timed FROM events, generate_series(1, 10) AS s(n)
""",
    "decode_json": FEED + "SELECT event_id AS seq, kind <> 'bad_json' AS valid FROM feed",
    "payload_shape": FEED + """
SELECT event_id AS seq,
  CASE kind WHEN 'bad_json' THEN NULL WHEN 'scalar_root' THEN 'other' WHEN 'empty_list' THEN 'list'
            ELSE 'object' END AS root
FROM feed
""",
    "structure_violations": FEED + """
SELECT event_id AS seq,
  CAST(CASE kind WHEN 'bad_json' THEN NULL WHEN 'no_fields' THEN 1 WHEN 'scalar_root' THEN 1
                 WHEN 'flat_fields' THEN 2 ELSE 0 END AS INTEGER) AS violations
FROM feed
""",
    "accepted_payloads": FEED + "SELECT event_id AS seq FROM feed WHERE sound",
    "rejected_payloads": _WHOLE + f"""
SELECT event_id AS seq, {_REASON} AS reason, {_PAYLOAD} AS payload,
  CAST(CASE kind WHEN 'bad_json' THEN NULL WHEN 'no_fields' THEN 1 WHEN 'scalar_root' THEN 1
                 WHEN 'flat_fields' THEN 2 ELSE 0 END AS INTEGER) AS violations
FROM written WHERE NOT stored
""",
    "batch_explode": LISTS + """
SELECT batch AS seq, CAST(pos AS INTEGER) AS pos, 'dev-' || user_id AS deviceid FROM lists
""",
    "batch_header": LISTS + """
SELECT batch AS seq, CAST(pos AS INTEGER) AS pos, first_stamp AS "timestamp", first_device AS deviceid
FROM lists WHERE aligned
""",
    "fixed_columns": FEED + """
SELECT event_id AS seq, stamp AS "timestamp", device AS deviceid FROM feed WHERE parsed
""",
    "route": FEED + "SELECT event_id AS seq, route_schema, route_table FROM feed WHERE parsed",
    "flatten_long": CELLS + 'SELECT event_id AS seq, "column", tag, text FROM cells',
    "flatten_wide": FEED + """
SELECT event_id AS seq, route_table, stamp AS "timestamp", device AS deviceid,
  CASE kind WHEN 'bad_cell' THEN NULL ELSE value END AS value,
  CAST(k_value AS DOUBLE) AS k, props_value AS props,
  CASE event_type WHEN 'error' THEN 'err ' || event_id END AS message,
  CAST(CASE event_type WHEN 'error' THEN event_id % 5 END AS DOUBLE) AS level,
  CASE event_type WHEN 'error' THEN 'TCP' END AS source
FROM feed WHERE parsed
""",
    "wide_record": f"""
SELECT c_custkey AS seq, 'd' || c_custkey AS deviceid, 'c' || i AS name, CAST((c_custkey + i) / 4 AS DOUBLE) AS value
FROM customer, generate_series(1, {WIDE_FIELDS}) AS fields(i)
""",
    "batch_alignment": LISTS + "SELECT DISTINCT batch AS seq, aligned FROM lists",
    "type_mapping": CELLS + """
SELECT "column", tag, storage, count(*) AS cells FROM typed GROUP BY "column", tag, storage
""",
    "json_cell": FEED + "SELECT event_id AS seq, props_value AS text FROM feed WHERE parsed",
    "cell_coercion": CELLS + """
SELECT event_id AS seq, "column", storage, NOT (kind = 'bad_cell' AND "column" = 'value') AS fits,
  CASE storage WHEN 'DOUBLE' THEN TRY_CAST(text AS DOUBLE) END AS number,
  CASE WHEN storage <> 'DOUBLE' THEN text END AS text_value
FROM typed
""",
    "message_fork": FEED + """
SELECT event_id AS seq, stamp AS "timestamp", device AS deviceid, 'err ' || event_id AS message,
  CAST(event_id % 5 AS DOUBLE) AS level, 'TCP' AS source, CAST(NULL AS VARCHAR) AS logpath
FROM feed WHERE parsed AND event_type = 'error'
""",
    "message_last_in_batch": LISTS + """
SELECT batch AS seq, CAST(pos AS INTEGER) AS pos, date_trunc('second', ts) AS "timestamp",
  'dev-' || user_id AS deviceid, 'err ' || event_id AS message,
  CAST(event_id % 5 AS DOUBLE) AS level, 'TCP' AS source, CAST(NULL AS VARCHAR) AS logpath
FROM lists WHERE has_message
QUALIFY row_number() OVER (PARTITION BY batch ORDER BY pos DESC) = 1
""",
    "not_null_gate": FEED + "SELECT event_id AS seq, kind <> 'ts_null' AS passed FROM feed WHERE sound",
    "ensure_schema": FEED + "SELECT DISTINCT route_schema AS schema_name FROM feed WHERE parsed",
    "plain_table_with_id": """
SELECT row_number() OVER (ORDER BY event_id) AS id, CAST(event_id AS DOUBLE) AS event_id,
  CAST(user_id AS DOUBLE) AS user_id, event_type, value, props
FROM events
""",
    "time_partitioned_table": FEED + """
SELECT route_table AS table_name, CAST(stamp AS DATE) AS ts_date, count(*) AS rows FROM feed
WHERE stored GROUP BY ALL
UNION ALL
SELECT 'message', CAST(stamp AS DATE) AS ts_date, count(*) FROM feed
WHERE parsed AND event_type = 'error' GROUP BY ts_date
""",
    "time_range": FEED + """
SELECT stamp AS "timestamp", device AS deviceid, CAST(k_value AS DOUBLE) AS k, props_value AS props, value
FROM feed
WHERE stored AND route_schema = 'telemetry' AND route_table = 'view'
  AND stamp >= TIMESTAMP '2024-01-10 06:00:00' AND stamp < TIMESTAMP '2024-01-12 18:00:00'
""",
    "schema_evolution": EVOLVING + """
SELECT date_trunc('second', ts) AS "timestamp", 'dev-' || user_id AS deviceid, value,
  CASE WHEN part >= 1 THEN k_value END AS k, CASE WHEN part = 2 THEN props_value END AS props
FROM evolving
""",
    "many_columns": f"""
SELECT 'd' || p_partkey AS deviceid, 'c' || (p_partkey % {MANY_COLUMNS}) AS filled, p_partkey + CAST(0.5 AS DOUBLE) AS value
FROM part
""",
    "column_dictionary": CELLS + """
SELECT route_schema, route_table, "column", storage, min(event_id) AS first_seq
FROM typed GROUP BY route_schema, route_table, "column", storage
UNION ALL
SELECT 'public', 'message', "column", storage, min(event_id)
FROM typed WHERE "column" IN ('message', 'level', 'source') GROUP BY "column", storage
""",
    "append_batch": LISTS + """
SELECT first_stamp AS "timestamp", first_device AS deviceid, value, CAST(k_value AS DOUBLE) AS k,
  CASE WHEN has_message THEN 'err ' || event_id END AS message,
  CAST(CASE WHEN has_message THEN event_id % 5 END AS DOUBLE) AS level,
  CASE WHEN has_message THEN 'TCP' END AS source
FROM lists WHERE aligned
""",
    "ensure_then_append": EVOLVING + """
SELECT date_trunc('second', ts) AS "timestamp", 'dev-' || user_id AS deviceid, value,
  CASE WHEN part >= 1 THEN k_value END AS k, CASE WHEN part = 2 THEN props_value END AS props,
  CAST(ts AS DATE) AS ts_date, 'part-' || part AS ingest_batch
FROM evolving
""",
    "routed_append": _all_tables(),
    "latest_n": FEED + """
SELECT stamp AS "timestamp", device AS deviceid, CAST(k_value AS DOUBLE) AS k,
  CAST(event_id % 5 AS DOUBLE) AS level, 'err ' || event_id AS message, props_value AS props,
  'TCP' AS source, value
FROM feed WHERE stored AND route_schema = 'telemetry' AND route_table = 'error'
ORDER BY stamp DESC NULLS FIRST, message DESC NULLS FIRST LIMIT 5
""",
    "projection_list": FEED + """
SELECT stamp AS "timestamp", device AS deviceid, 'err ' || event_id AS message, value * 2 AS doubled
FROM feed WHERE stored AND route_schema = 'telemetry' AND route_table = 'error'
ORDER BY message DESC NULLS FIRST LIMIT 20
""",
    "latest_n_missing": FEED + """
(SELECT 'present' AS case_name, stamp AS "timestamp", 'err ' || event_id AS message FROM feed
WHERE stored AND route_schema = 'telemetry' AND route_table = 'error'
ORDER BY stamp DESC, message DESC LIMIT 5)
UNION ALL SELECT 'no_table', NULL, NULL UNION ALL SELECT 'no_column', NULL, NULL
""",
    "publish_fanout": """
SELECT topic, '{"event_id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type
  || '"}' AS payload
FROM events, (VALUES ('topic/x'), ('topic/y')) AS t(topic)
""",
    "stream_admission": "SELECT event_id AS seq, 4 AS batches FROM events",
    "stream_ingest": _all_tables(),
    "stream_restart": _all_tables(),
    "replay_idempotent": LISTS + """
SELECT 'batch' AS table_name, first_stamp AS "timestamp", first_device AS deviceid, value, CAST(k_value AS DOUBLE) AS k,
  CASE WHEN has_message THEN 'err ' || event_id END AS message,
  CAST(CASE WHEN has_message THEN event_id % 5 END AS DOUBLE) AS level,
  CASE WHEN has_message THEN 'TCP' END AS source
FROM lists WHERE aligned
UNION ALL
SELECT 'message', date_trunc('second', ts), 'dev-' || user_id, NULL, NULL, 'err ' || event_id,
  CAST(event_id % 5 AS DOUBLE), 'TCP'
FROM lists WHERE has_message
""",
    "replay_changed": _all_tables(
        "event_id > (SELECT (min(event_id) + max(event_id)) // 2 FROM events)",
        ", CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS target, CAST(NULL AS VARCHAR) AS reason",
    ) + f"""
UNION ALL
SELECT 'rejects', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, event_id, target, {_REASON}
FROM feed, (VALUES ('data'), ('message')) AS t(target)
WHERE NOT stored AND event_id > (SELECT (min(event_id) + max(event_id)) // 2 FROM events)
  AND (target = 'data' OR (kind = 'ts_null' AND event_type = 'error'))
""",
    "isolated_routes": f"""
WITH kinds AS (
  SELECT *, event_id % 50 AS kind, event_id % 50 BETWEEN 5 AND 9 AND event_id // 50 % {BAD_LONG_CELLS} = 0 AS bad_cell
  FROM events
)
SELECT CASE kind {_LONG} ELSE 'telemetry.good' END AS outcome, 'dev-' || user_id AS deviceid, value, CAST(NULL AS BIGINT) AS seq
FROM kinds WHERE kind > 4 AND NOT bad_cell
UNION ALL
SELECT CASE WHEN bad_cell THEN 'cast_failed' WHEN kind = 3 THEN 'bad_table' ELSE 'bad_route' END, NULL, NULL, event_id
FROM kinds WHERE kind <= 4 OR bad_cell
""",
    "parked_tables": _unparked(),
    "parked_stream": _unparked(),
    "committed_loads": FEED + f"""
, tables AS (
  SELECT event_id, route_table AS table_name, value, stamp FROM feed WHERE stored
  UNION ALL SELECT event_id, 'message', NULL, stamp FROM feed WHERE parsed AND event_type = 'error'
), states AS (
  SELECT 'broken off' AS state, * FROM tables WHERE event_id <= (SELECT (min(event_id) + max(event_id)) // 2 FROM events)
  UNION ALL SELECT 'repeated', * FROM tables
)
SELECT state, table_name, count(*) AS rows, sum(value) AS total FROM states GROUP BY state, table_name
UNION ALL
SELECT state, 'newest view', 1, value FROM states WHERE table_name = 'view'
QUALIFY row_number() OVER (PARTITION BY state ORDER BY stamp DESC, value DESC) <= 3
""",
    "day_counts": LISTS + """
SELECT 'batch' AS table_name, CAST(first_stamp AS DATE) AS day, count(*) AS rows FROM lists WHERE aligned GROUP BY day
UNION ALL
SELECT 'message', CAST(ts AS DATE) AS day, count(*) FROM lists WHERE has_message GROUP BY day
""",
    "latest_sparse": """
SELECT make_timestamp(1830 + 3 * (p_partkey % 100), 1, 1, 0, 0, 0) AS "timestamp", 'd' || (p_partkey % 100) AS deviceid,
  CAST(1 AS DOUBLE) AS value
FROM part ORDER BY "timestamp" DESC LIMIT 7
""",
    "text_lines": _WHOLE + f"""
SELECT row_number() OVER (ORDER BY event_id) - 1 AS seq, 'plant' AS topic, {_PAYLOAD} AS payload FROM written
""",
    "text_stream": _all_tables(),
    "interleaved_appends": """
SELECT 'part-' || (event_id % 4) AS append, count(*) AS rows, count(*) AS keys, true AS in_order
FROM events GROUP BY event_id % 4
UNION ALL SELECT 'all', count(*), count(*), true FROM events
""",
    "compacted": _all_tables(
        more=""", CAST(stamp AS DATE) AS ts_date, CASE WHEN event_id % 3 = 2 THEN 'part-2' ELSE 'merged-' END AS ingest_batch"""
    ),
    "ledger_compacted": FEED + f"""
SELECT 'refused' AS entry, 'part-' || event_id % 4 AS load, event_id AS seq, target AS name, {_REASON} AS state
FROM feed, (VALUES ('data'), ('message')) AS t(target)
WHERE NOT stored AND (target = 'data' OR (kind = 'ts_null' AND event_type = 'error'))
UNION ALL
SELECT DISTINCT 'noted', 'part-' || event_id % 4, NULL, name, CASE event_id % 4 WHEN 3 THEN 'open' ELSE 'closed' END
FROM (
  SELECT event_id, route_table AS name FROM feed WHERE parsed
  UNION ALL SELECT event_id, 'message' FROM feed WHERE parsed AND event_type = 'error'
)
UNION ALL SELECT 'refused folders', NULL, 2, NULL, NULL
UNION ALL SELECT 'noted folders', NULL, 2, NULL, NULL
UNION ALL SELECT 'repeated', 'part-0', NULL, NULL, 'stored'
""",
    "hourly_table": _partitions(
        _HOURS, "CAST(stamp AS DATE) AS ts_date, CAST(hour(stamp) AS INTEGER) AS hour, CAST(hour(stamp) AS INTEGER) AS ts_hour"
    ),
    "monthly_table": _partitions(_MONTHS, "CAST(date_trunc('month', stamp) AS DATE) AS ts_date"),
    "hourly_reads": _read_back(_HOURS, "2024-01-01 22:30:00", "2024-01-02 03:00:00"),
    "monthly_reads": _read_back(_MONTHS, "2024-05-10 00:00:00", "2024-06-05 12:30:00"),
    "variant_columns": FEED + """
SELECT route_table AS table_name, stamp AS "timestamp", device AS deviceid, value, k_value AS k, props_value AS props
FROM feed WHERE stored AND k_value > 50
""",
    "delimited_payloads": f"""
WITH kinds AS (SELECT *, CASE {_DELIMITED_RULES} ELSE 'clean' END AS kind FROM events)
SELECT date_trunc('second', ts) AS "timestamp", 'dev-' || user_id AS deviceid, value,
  CASE WHEN event_id % 5 > 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k, replace(props, ' ', '') AS props,
  'say "' || event_type || '", twice' AS note, 'stored' AS outcome, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS INTEGER) AS violations
FROM kinds WHERE kind = 'clean'
UNION ALL
SELECT DISTINCT NULL, NULL, NULL, NULL, NULL, NULL,
  CASE kind WHEN 'empty' THEN 'bad_payload_type' WHEN 'bad_cell' THEN 'cast_failed' WHEN 'short_line' THEN 'structure'
            WHEN 'open_quote' THEN 'structure' ELSE kind END,
  event_id // 4, CASE kind WHEN 'duplicate_column' THEN NULL WHEN 'empty_batch' THEN 0 WHEN 'bad_cell' THEN 0 ELSE 1 END
FROM kinds WHERE kind <> 'clean'
""",
    "write_messages": _WHOLE + f"""
SELECT sent AS sent_to, event_id AS seq, {_TOPIC} AS topic, {_PAYLOAD} AS payload
FROM written, (VALUES ('topic/x'), ('topic/y')) AS t(sent)
""",
    "ingest_metrics": FEED + """
SELECT 'stored' AS metric, route_table AS name, count(*) AS value FROM feed WHERE stored GROUP BY route_table
UNION ALL
SELECT 'stored', 'message', count(*) FROM feed WHERE parsed AND event_type = 'error'
UNION ALL
SELECT 'refused',
  CASE kind WHEN 'bad_json' THEN 'bad_json' WHEN 'scalar_root' THEN 'bad_payload_type'
            WHEN 'empty_list' THEN 'empty_batch' WHEN 'ts_null' THEN 'null_timestamp'
            WHEN 'bad_cell' THEN 'cast_failed' ELSE 'structure' END AS name,
  count(*) + count(*) FILTER (kind = 'ts_null' AND event_type = 'error')
FROM feed WHERE NOT stored GROUP BY name
""",
    "parser_registry": FEED + """
SELECT event_id AS seq, 'data' AS target,
  CASE kind WHEN 'bad_json' THEN 'bad_json' WHEN 'scalar_root' THEN 'bad_payload_type'
            WHEN 'empty_list' THEN 'empty_batch' WHEN 'ts_null' THEN 'null_timestamp'
            WHEN 'no_fields' THEN 'structure' WHEN 'flat_fields' THEN 'structure' END AS reason
FROM feed WHERE event_type = 'error'
UNION ALL
SELECT event_id, 'message', CASE kind WHEN 'ts_null' THEN 'null_timestamp' END
FROM feed WHERE event_type = 'error' AND sound
""",
}
