"""DuckDB SQL for the registered queries, over the same tables.

The statements are written against the tables alone and share nothing with the
Spark operators but the fixed rules. Each is a list of common table expressions
and a final SELECT.
"""

from __future__ import annotations

_SENSOR_ID = """'sensor-' || CASE WHEN length(CAST(user_id AS VARCHAR)) < 4
  THEN lpad(CAST(user_id AS VARCHAR), 4, '0') ELSE CAST(user_id AS VARCHAR) END"""

_TEMPERATURE = "isnan(temp_c) OR temp_c < -50 OR temp_c > 60"
_COORDINATES = "lat < 45.7 OR lat > 48.6 OR lon < 16.1 OR lon > 22.9"
_TEMPERATURE_TEXT = "'temperature out of plausible range: ' || printf('%.1f', temp_c) || '°C'"
_COORDINATES_TEXT = (
    "'coordinates outside Hungary: (' || printf('%.4f', lat) || ', ' || printf('%.4f', lon) || ')'"
)

_CTES = {
    "readings": f"""SELECT {_SENSOR_ID} AS sensor_id,
  CAST(455 + user_id % 32 AS DOUBLE) / 10 AS lat, CAST(160 + user_id % 70 AS DOUBLE) / 10 AS lon,
  value - 10 AS temp_c, ts, ts + to_seconds(event_id % 6) AS arrival_ts,
  CAST(user_id % 6 AS INTEGER) AS "partition", event_id * 2 AS "offset",
  event_id, user_id, event_type FROM events""",
    "checked": f"""SELECT *,
  CASE WHEN {_TEMPERATURE} THEN {_TEMPERATURE_TEXT} WHEN {_COORDINATES} THEN {_COORDINATES_TEXT} END AS reason,
  CASE WHEN {_TEMPERATURE} THEN 'temperature' WHEN {_COORDINATES} THEN 'coordinates' END AS reason_code
  FROM readings""",
    "clean": "SELECT * FROM checked WHERE reason IS NULL",
    "deliveries": """SELECT sensor_id, ts, lat, lon, temp_c, "partition", "offset" FROM clean
  UNION ALL SELECT sensor_id, ts, lat, lon, temp_c + 1, "partition", "offset" + 1 FROM clean
  WHERE event_type = 'purchase'""",
    "stored": """SELECT sensor_id, ts, lat, lon, temp_c FROM (SELECT *, row_number() OVER (
  PARTITION BY sensor_id, ts ORDER BY "partition", "offset") AS nth FROM deliveries) WHERE nth = 1""",
    # The payload of an error event has the fault numbered user_id % 12.
    "raw": """SELECT * REPLACE (CASE WHEN fault = 9 THEN 0.0 ELSE temp_c END AS temp_c),
  replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z' AS ts_text, temp_c AS sent_temp_c
  FROM (SELECT *, CASE WHEN event_type = 'error' THEN user_id % 12 END AS fault FROM readings)""",
    "decoded": f"""SELECT *, CASE
  WHEN fault IN (0, 1, 4) THEN 'unmarshal: invalid JSON'
  WHEN fault = 3 THEN 'unmarshal: not a JSON object'
  WHEN fault = 5 THEN 'unmarshal: field sensor_id is not a string'
  WHEN fault = 6 THEN 'unmarshal: field lat is not a number'
  WHEN fault = 7 THEN 'unmarshal: field ts is not an RFC 3339 time'
  WHEN fault = 2 THEN 'validate: sensor id is required'
  WHEN fault = 8 THEN 'validate: timestamp is required'
  WHEN {_TEMPERATURE} THEN 'validate: ' || {_TEMPERATURE_TEXT}
  WHEN {_COORDINATES} THEN 'validate: ' || {_COORDINATES_TEXT} END AS reason,
  CASE WHEN fault IN (0, 1, 3, 4, 5, 6, 7) THEN 'unmarshal' WHEN fault = 2 THEN 'missing_id'
  WHEN fault = 8 THEN 'missing_time' WHEN {_TEMPERATURE} THEN 'temperature'
  WHEN {_COORDINATES} THEN 'coordinates' END AS reason_code FROM raw""",
    "payloads": """SELECT *, CASE fault
  WHEN 0 THEN 'not json at all' WHEN 1 THEN '' WHEN 2 THEN 'null' WHEN 3 THEN '[]'
  WHEN 4 THEN good || ' trailing'
  WHEN 5 THEN '{"sensor_id":5,' || place || temp || time || '}'
  WHEN 6 THEN '{"sensor_id":"' || sensor_id || '","lat":"47.5","lon":' || lon || temp || time || '}'
  WHEN 7 THEN '{"sensor_id":"' || sensor_id || '",' || place || temp || ',"ts":"' || ts_text[1:10] || '"}'
  WHEN 8 THEN '{"sensor_id":"' || sensor_id || '",' || place || temp || '}'
  WHEN 9 THEN '{"sensor_id":"' || sensor_id || '",' || place || time || '}'
  WHEN 10 THEN good[1:length(good) - 1] || ',"extra":"v2"}'
  WHEN 11 THEN '{"sensor_id":"first",' || good[2:]
  ELSE good END AS payload FROM (SELECT *,
    '{"sensor_id":"' || sensor_id || '",' || place || temp || time || '}' AS good FROM (SELECT *,
      '"lat":' || lat || ',"lon":' || lon AS place, ',"temp_c":' || sent_temp_c AS temp,
      ',"ts":"' || ts_text || '"' AS time FROM decoded))""",
    "picked": """SELECT user_id, arg_min(value, event_id) AS first_value, arg_min(ts, event_id) AS first_ts,
  arg_min(event_type, event_id) AS first_type, arg_max(value, event_id) AS last_value,
  arg_max(event_type, event_id) AS last_type FROM events GROUP BY user_id""",
    "settings": f"""SELECT *, {_SENSOR_ID} AS id,
  CAST(455 + user_id % 32 AS DOUBLE) / 10 AS lat, CAST(160 + user_id % 70 AS DOUBLE) / 10 AS lon,
  first_value - 10 AS start_temp_c,
  ['steady', 'rising', 'falling', 'noisy', 'sideways'][user_id % 5 + 1] AS pattern,
  user_id % 40 * 1000000000 AS interval_ns, first_ts AS created_at FROM picked""",
    "changes": f"""SELECT event_id AS seq, {_SENSOR_ID} AS id,
  CAST(455 + user_id % 32 AS DOUBLE) / 10 AS lat, CAST(160 + user_id % 70 AS DOUBLE) / 10 AS lon,
  value - 10 AS temp_c,
  ['steady', 'rising', 'falling', 'noisy', 'sideways'][user_id % 5 + 1] AS pattern,
  user_id % 40 AS seconds, ts AS created_at FROM events""",
    "checked_changes": f"""SELECT *,
  CASE WHEN {_TEMPERATURE} THEN {_TEMPERATURE_TEXT} WHEN {_COORDINATES} THEN {_COORDINATES_TEXT}
  WHEN pattern = 'sideways' THEN 'unknown drift pattern: "sideways" (want steady, rising, falling or noisy)'
  WHEN seconds < 1 OR seconds > 30 THEN 'interval outside 1s-30s: got ' || seconds || 's' END AS reason,
  CASE WHEN {_TEMPERATURE} THEN 'temperature' WHEN {_COORDINATES} THEN 'coordinates'
  WHEN pattern = 'sideways' THEN 'pattern' WHEN seconds < 1 OR seconds > 30 THEN 'interval' END AS reason_code
  FROM changes""",
    "requested": f"""SELECT id AS request_key, 'sensor-' || sha256(id)[1:8] AS id, lat, lon, user_id % 7 = 2 AS unparsed,
  CASE WHEN user_id % 3 = 0 THEN 15.0 WHEN user_id % 3 = 1 THEN 0.0 ELSE start_temp_c END AS temp_c,
  CASE WHEN user_id % 4 IN (0, 1) THEN 'noisy' ELSE pattern END AS pattern,
  CASE WHEN user_id % 7 IN (0, 1) THEN 5 WHEN user_id % 7 = 2 THEN NULL ELSE user_id % 40 END AS seconds
  FROM settings""",
    "registered": f"""SELECT *,
  CASE WHEN unparsed THEN 'interval: "fast" is not a duration (try "5s")'
  WHEN {_TEMPERATURE} THEN {_TEMPERATURE_TEXT} WHEN {_COORDINATES} THEN {_COORDINATES_TEXT}
  WHEN pattern = 'sideways' THEN 'unknown drift pattern: "sideways" (want steady, rising, falling or noisy)'
  WHEN seconds < 1 OR seconds > 30 THEN 'interval outside 1s-30s: got ' || seconds || 's' END AS reason,
  CASE WHEN unparsed THEN 'duration' WHEN {_TEMPERATURE} THEN 'temperature'
  WHEN {_COORDINATES} THEN 'coordinates' WHEN pattern = 'sideways' THEN 'pattern'
  WHEN seconds < 1 OR seconds > 30 THEN 'interval' END AS reason_code FROM requested""",
}

_NEEDS = {
    "readings": [],
    "checked": ["readings"],
    "clean": ["checked"],
    "deliveries": ["clean"],
    "stored": ["deliveries"],
    "raw": ["readings"],
    "decoded": ["raw"],
    "payloads": ["decoded"],
    "picked": [],
    "settings": ["picked"],
    "changes": [],
    "checked_changes": ["changes"],
    "requested": ["settings"],
    "registered": ["requested"],
}


def _with(*names: str, more: dict[str, str] | None = None) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS[name]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in names:
        add(name)
    parts = {name: _CTES[name] for name in order} | (more or {})
    return "WITH " + ",\n".join(f"{name} AS ({text})" for name, text in parts.items()) + "\n"


def _bucket(size: int, origin: int = 0, ts: str = "ts") -> str:
    """Window start for a size and origin in seconds."""
    return (
        f"make_timestamp(epoch_us({ts}) - (epoch_us({ts}) - {origin * 1_000_000}) % {size * 1_000_000})"
    )


def _summary(source: str, size: int, origin: int = 0, scope: str = "'national'") -> str:
    start = _bucket(size, origin)
    return f"""SELECT {scope} AS scope, {start} AS window_start,
  {start} + to_seconds({size}) AS window_end,
  round(CAST(sum(CAST(temp_c AS DECIMAL(18, 6))) AS DOUBLE) / count(*) * 100) / 100 + 0.0 AS avg_temp_c,
  min(temp_c) AS min_temp_c, max(temp_c) AS max_temp_c, count(*) AS "count"
  FROM {source} GROUP BY ALL"""


def _late(size: int, grace: int = 2) -> str:
    return f"arrival_ts >= {_bucket(size)} + to_seconds({size + grace})"


_RFC3339 = "replace(CAST({0} AS VARCHAR), ' ', 'T') || 'Z'"

_SENSOR_LIST = "id, lat, lon, start_temp_c, pattern, interval_ns, created_at"

_REGIONAL = _summary(
    """(SELECT c.*, coalesce(n.n_name, 'unassigned') AS n_name FROM clean c LEFT JOIN nation n
  ON c.lon >= CAST(n.n_nationkey AS DOUBLE) / 4 + 16 AND c.lon < CAST(n.n_nationkey + 1 AS DOUBLE) / 4 + 16)""",
    3600,
    scope="n_name",
)

ORACLE: dict[str, str] = {
    "tumbling_10s": _with("clean") + _summary("clean", 10),
    "tumbling_1h": _with("clean") + _summary("clean", 3600),
    "tumbling_7d": _with("clean") + _summary("clean", 604800, 345600),
    "tumbling_7s": _with("clean") + _summary("clean", 7, 3),
    "tumbling_10s_on_time": _with("clean") + _summary(f"(SELECT * FROM clean WHERE NOT ({_late(10)}))", 10),
    "window_assignment": _with("readings")
    + f"""SELECT event_id, {_bucket(10)} AS window_start, {_bucket(10)} + to_seconds(10) AS window_end,
  {_late(10)} AS late FROM readings""",
    "late_count": _with("clean") + f"SELECT count(*) FILTER ({_late(10)}) AS late FROM clean",
    "conservation": _with("clean")
    + f"""SELECT count(*) AS offered, count(*) FILTER (NOT ({_late(10)})) AS stored,
  count(*) FILTER ({_late(10)}) AS late, true AS balanced FROM clean""",
    "closed_windows": _with("clean", more={"hourly": _summary("clean", 3600)})
    + """SELECT * FROM hourly
  WHERE window_end + INTERVAL 2 HOUR <= (SELECT max(ts) FROM clean)""",
    "tumbling_with_duplicates": _with("deliveries") + _summary("deliveries", 3600),
    "tumbling_first_deliveries": _with("stored") + _summary("stored", 3600),
    "future_readings": _with("readings")
    + """SELECT event_id, ts, arrival_ts FROM (SELECT event_id, ts, CASE WHEN event_type = 'purchase'
  THEN arrival_ts - INTERVAL 1 HOUR ELSE arrival_ts END AS arrival_ts FROM readings)
  WHERE ts > arrival_ts + INTERVAL 1 MINUTE""",
    "validate_readings": _with("checked") + "SELECT event_id, reason, reason_code FROM checked",
    "reject_reasons": _with("checked")
    + "SELECT reason, count(*) AS n FROM checked WHERE reason IS NOT NULL GROUP BY reason",
    "reject_classes": _with("checked")
    + "SELECT reason_code, count(*) AS n FROM checked WHERE reason_code IS NOT NULL GROUP BY reason_code",
    "validate_aggregates": _with("clean", more={"ten": _summary("clean", 10)})
    + """SELECT window_start, CASE WHEN m = 0 THEN 'scope is required'
  WHEN m = 1 THEN 'window end must be after start: start ' || t || ', end ' || t
  WHEN m = 2 AND s < 30 THEN 'aggregate of zero readings'
  WHEN m = 3 THEN 'min ' || printf('%.1f', max_temp_c + 1) || ' exceeds max ' || printf('%.1f', max_temp_c) END AS reason,
  CASE WHEN m = 0 THEN 'missing_scope' WHEN m = 1 THEN 'window' WHEN m = 2 AND s < 30 THEN 'empty_window'
  WHEN m = 3 THEN 'min_over_max' END AS reason_code
  FROM (SELECT *, minute(window_start) AS m, second(window_start) AS s,
  """
    + _RFC3339.format("window_start")
    + " AS t FROM ten)",
    "validate_dead_letters": _with("readings")
    + """SELECT "offset", CASE event_type WHEN 'view' THEN 'missing_topic' WHEN 'click' THEN 'missing_reason'
  WHEN 'signup' THEN 'missing_failed_at' END AS reason_code FROM readings""",
    "validate_sensors": _with("checked_changes") + "SELECT seq, id, reason, reason_code FROM checked_changes",
    "pattern_membership": _with("changes")
    + "SELECT pattern, count(*) AS n, pattern <> 'sideways' AS known FROM changes GROUP BY pattern",
    "failure_classes": _with("checked")
    + """SELECT CASE WHEN reason IS NULL THEN 'none' ELSE 'bad_data' END AS failure, count(*) AS n
  FROM checked GROUP BY 1""",
    "decode_readings": _with("decoded")
    + """SELECT "partition", "offset", reason, reason_code,
  CASE WHEN reason IS NULL THEN sensor_id END AS sensor_id, CASE WHEN reason IS NULL THEN lat END AS lat,
  CASE WHEN reason IS NULL THEN lon END AS lon, CASE WHEN reason IS NULL THEN temp_c END AS temp_c,
  CASE WHEN reason IS NULL THEN ts END AS ts FROM decoded""",
    "poison_split": _with("decoded")
    + """SELECT "partition", count(*) FILTER (reason IS NULL) AS delivered,
  count(*) FILTER (reason IS NOT NULL) AS rejected FROM decoded GROUP BY "partition" """,
    "rejection_metrics": _with("decoded")
    + "SELECT reason_code, count(*) AS n FROM decoded WHERE reason_code IS NOT NULL GROUP BY reason_code",
    "log_and_skip": _with("decoded")
    + 'SELECT "partition", "offset", sensor_id, temp_c FROM decoded WHERE reason IS NULL',
    "dlq_envelopes": _with("payloads")
    + """SELECT 'sensor.readings' AS source_topic, "partition", "offset", reason,
  to_base64(encode(payload)) AS payload_base64 FROM payloads WHERE reason IS NOT NULL""",
    "dlq_read_back": _with("payloads")
    + """SELECT 'sensor.readings' AS source_topic, "partition", "offset", reason, arrival_ts AS failed_at,
  payload FROM payloads WHERE reason IS NOT NULL""",
    "clean_encode": _with("decoded")
    + """SELECT "offset", 'lat,lon,sensor_id,temp_c,ts' AS fields, true AS within_budget, sensor_id, lat, lon,
  temp_c, ts_text AS ts FROM decoded WHERE reason IS NULL""",
    "clean_topic_rows": _with("decoded")
    + """SELECT sensor_id, 'sensor.readings.clean' AS topic, count(*) AS n, min("offset") AS first_offset,
  max("offset") AS last_offset, true AS one_partition FROM decoded WHERE reason IS NULL GROUP BY sensor_id""",
    "rfc3339_round_trip": _with("readings")
    + f"""SELECT event_id, {_RFC3339.format("ts")} AS text, ts AS utc, ts - INTERVAL 2 HOUR AS east,
  ts + INTERVAL 1410 MINUTE AS far_west, true AS date_refused FROM readings""",
    "duration_round_trip": _with("readings")
    + """SELECT event_id, epoch_us(ts) % 7200000000 * 1000 AS nanos,
  s * 60000000000 + (s + 30) * 1000000000 + 500000000 AS minutes_and_seconds,
  CASE WHEN s >= 60 THEN '1m' || (s - 60) || 's' ELSE s || 's' END AS text, true AS word_refused
  FROM (SELECT event_id, ts, event_id % 90 AS s FROM readings)""",
    "rounding": """SELECT l_orderkey, l_linenumber,
  round(l_extendedprice * (1 - l_discount) * 100) / 100 + 0.0 AS net FROM lineitem""",
    "history_dedup": _with("stored") + "SELECT * FROM stored",
    "history_dedup_any_position": _with("stored") + "SELECT * FROM stored",
    "insert_ignore": _with("stored")
    + """SELECT s.* FROM stored s WHERE NOT EXISTS (SELECT 1 FROM clean c
  WHERE c.event_type = 'purchase' AND c.sensor_id = s.sensor_id AND c.ts = s.ts)""",
    "readings_per_sensor": _with("stored")
    + 'SELECT sensor_id, count(*) AS "count" FROM stored GROUP BY sensor_id',
    "history_key_count": _with("stored")
    + """SELECT count(*) AS "count" FROM stored WHERE sensor_id = 'sensor-0008'""",
    "history_range": _with("stored")
    + """SELECT sensor_id, lat, lon, temp_c, ts FROM stored
  WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-15 18:00:00'""",
    "history_compacted": _with("stored") + "SELECT *, 'compacted' AS batch FROM stored",
    "retained_topic_rows": _with("readings")
    + """SELECT "partition", "offset", arrival_ts AS "timestamp" FROM readings
  WHERE arrival_ts >= (SELECT max(arrival_ts) FROM readings) - INTERVAL 1 HOUR""",
    "retention": _with("readings")
    + """SELECT count(*) FILTER (arrival_ts >= last - INTERVAL 24 HOUR) AS readings_kept,
  count(*) FILTER (arrival_ts >= last - INTERVAL 24 HOUR) AS clean_kept,
  count(*) FILTER (arrival_ts >= last - INTERVAL 7 DAY) AS dead_letters_kept,
  count(*) FILTER (arrival_ts >= last - INTERVAL 1 HOUR) AS aggregates_kept
  FROM (SELECT arrival_ts, max(arrival_ts) OVER () AS last FROM readings)""",
    "latest_offsets": _with("readings")
    + """SELECT 'sensor.readings' AS topic, "partition", max("offset") AS end_offset
  FROM readings GROUP BY "partition" """,
    "after_backlog": _with("readings")
    + """SELECT r."partition", r."offset", r.event_id FROM readings r JOIN (SELECT "partition",
  max("offset") AS last FROM readings WHERE event_type = 'signup' GROUP BY "partition") e
  ON r."partition" = e."partition" WHERE r."offset" > e.last""",
    "topic_lag": _with("readings")
    + """SELECT 'sensor.readings' AS topic, "partition", max("offset") AS newest,
  max("offset") - max("offset") FILTER (event_type = 'signup') AS lag FROM readings GROUP BY "partition" """,
    "live_feed_messages": _with("clean", more={"hourly": _summary("clean", 3600)})
    + f"""SELECT * REPLACE ({_RFC3339.format("window_start")} AS window_start,
  {_RFC3339.format("window_end")} AS window_end) FROM hourly WHERE window_start > (SELECT max(window_start)
  FROM hourly WHERE window_end < TIMESTAMP '2024-01-15 00:00:00')""",
    "register_sensors": _with("registered")
    + """SELECT request_key, id, lat, lon, temp_c AS start_temp_c, pattern,
  seconds * 1000000000 AS interval_ns, reason, reason_code FROM registered""",
    "register_response": _with("registered")
    + """SELECT id, lat, lon, temp_c AS start_temp_c, pattern, seconds || 's' AS "interval",
  TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM registered WHERE reason IS NULL""",
    "register_collisions": _with("registered")
    + """SELECT 'sensor-' || sha256(request_key)[1:2] AS id, min(request_key) AS first_request,
  max(request_key) AS last_request FROM registered GROUP BY 1 HAVING count(*) > 1""",
    "register_unique_ids": _with("requested")
    + """SELECT request_key, 'sensor-' || said AS id FROM (
  SELECT request_key, sha256(request_key)[1:n] AS said, n, count(*) OVER (PARTITION BY sha256(request_key)[1:n]) AS sharing
  FROM requested, unnest(range(2, 65)) AS lengths(n))
  WHERE sharing = 1 QUALIFY row_number() OVER (PARTITION BY request_key ORDER BY n) = 1""",
    "registry_current": _with("settings", "checked_changes")
    + f"""SELECT {_SENSOR_LIST} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY step DESC, seq DESC) AS nth FROM (
  SELECT 0 AS step, 0 AS seq, {_SENSOR_LIST} FROM settings WHERE first_type <> 'click' UNION ALL
  SELECT 3, 0, {_SENSOR_LIST} FROM settings WHERE user_id % 7 = 0 UNION ALL
  SELECT CASE e.event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 4 END, seq, id, lat, lon, temp_c, pattern,
  seconds * 1000000000, created_at FROM checked_changes c JOIN events e ON e.event_id = c.seq
  WHERE reason IS NULL AND e.event_type IN ('view', 'click', 'purchase'))) WHERE nth = 1 AND step <> 3""",
    "registry_round_trip": _with("settings") + f"SELECT {_SENSOR_LIST} FROM settings",
    "registry_quarantine": _with("settings")
    + """SELECT id, CASE fault WHEN 0 THEN 'lat' WHEN 1 THEN 'lon' WHEN 2 THEN 'start_temp_c'
  WHEN 3 THEN 'interval' WHEN 4 THEN 'created_at' END AS bad_field,
  CASE WHEN fault = 0 THEN NULL ELSE lat END AS lat, CASE WHEN fault = 1 THEN NULL ELSE lon END AS lon,
  CASE WHEN fault = 2 THEN NULL ELSE start_temp_c END AS start_temp_c,
  CASE WHEN fault = 3 THEN NULL ELSE interval_ns END AS interval_ns,
  CASE WHEN fault = 4 THEN NULL ELSE created_at END AS created_at
  FROM (SELECT *, CASE WHEN first_type = 'error' THEN user_id % 5 END AS fault FROM settings)""",
    "registry_list": _with("settings") + f"SELECT {_SENSOR_LIST} FROM settings WHERE first_type <> 'click'",
    "registry_get": _with("settings") + f"SELECT {_SENSOR_LIST} FROM settings WHERE id = 'sensor-0008'",
    "registry_upsert": _with("settings", "checked_changes")
    + f"""SELECT {_SENSOR_LIST} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS nth FROM (
  SELECT -1 AS seq, {_SENSOR_LIST} FROM settings WHERE first_type <> 'click' UNION ALL
  SELECT seq, id, lat, lon, temp_c, pattern, seconds * 1000000000, created_at
  FROM checked_changes WHERE reason IS NULL)) WHERE nth = 1""",
    "registry_remove": _with("settings")
    + f"SELECT {_SENSOR_LIST} FROM settings WHERE first_type = 'click'",
    "registry_removal_report": _with("settings")
    + "SELECT id, first_type <> 'click' AS existed FROM settings",
    "registry_diff": _with("settings")
    + """SELECT id, CASE WHEN first_type = 'click' THEN 'start' WHEN last_type = 'signup' THEN 'stop'
  ELSE 'keep' END AS action FROM settings WHERE NOT (first_type = 'click' AND last_type = 'signup')""",
    "registry_diff_with_changes": _with("settings")
    + """SELECT id, CASE WHEN first_type = 'click' THEN 'start' WHEN last_type = 'signup' THEN 'stop'
  WHEN first_value <> last_value THEN 'changed' ELSE 'keep' END AS action
  FROM settings WHERE NOT (first_type = 'click' AND last_type = 'signup')""",
    "regional_1h": _with("clean") + _REGIONAL,
    "stream_feed_from_latest": _with("clean", more={"hourly": _REGIONAL})
    + "SELECT * FROM hourly WHERE window_end >= TIMESTAMP '2024-01-15 00:00:00'",
    "service_metrics": _with("checked")
    + f"""SELECT 'ingestion' AS service, {_bucket(3600)} AS window_start, count(*) AS handled,
  count(*) / 3600.0 AS rate_per_second, count(reason) / count(*) AS error_share,
  avg(ms) AS avg_latency_ms, max(ms) AS max_latency_ms, quantile_disc(ms, 0.95) AS p95_latency_ms
  FROM (SELECT *, (epoch_us(arrival_ts) - epoch_us(ts)) / 1000.0 AS ms FROM checked) GROUP BY ALL""",
    "slo_burn": _with("readings")
    + f"""SELECT window_start, handled, good AS good_share, (1.0 - good) / 0.01 AS budget_burn FROM (
  SELECT {_bucket(3600)} AS window_start, count(*) AS handled,
  count(*) FILTER (arrival_ts <= ts + to_seconds(2)) / count(*) AS good FROM readings GROUP BY ALL)""",
    "stream_ingest_history": _with("decoded")
    + "SELECT sensor_id, lat, lon, temp_c, ts FROM decoded WHERE reason IS NULL",
    "stream_resumed_history": _with("decoded")
    + "SELECT sensor_id, lat, lon, temp_c, ts FROM decoded WHERE reason IS NULL",
    "handled_readings": _with("decoded")
    + "SELECT sensor_id, lat, lon, temp_c, ts FROM decoded WHERE reason IS NULL AND temp_c > 0",
    "replayed_batch": _with("decoded")
    + """SELECT 'history' AS output, count(DISTINCT (sensor_id, ts)) AS n FROM decoded WHERE reason IS NULL
  UNION ALL SELECT 'clean', count(*) FROM decoded WHERE reason IS NULL
  UNION ALL SELECT 'dead_letters', count(*) FROM decoded WHERE reason IS NOT NULL""",
    "stream_lag": """SELECT count(*) AS newest, count(*) FILTER (event_id % 2 = 0) AS "read",
  count(*) FILTER (event_id % 2 = 1) AS lag FROM events""",
    "stream_full_copies": _with("clean", more={"hourly": _summary("clean", 3600)})
    + "SELECT subscriber, scope, window_start FROM hourly, (VALUES ('one'), ('two')) s(subscriber)",
    "stream_ingest_outputs": _with("decoded")
    + """SELECT 'history' AS output, count(DISTINCT (sensor_id, ts)) AS n FROM decoded WHERE reason IS NULL
  UNION ALL SELECT 'clean', count(*) FROM decoded WHERE reason IS NULL
  UNION ALL SELECT 'dead_letters', count(*) FROM decoded WHERE reason IS NOT NULL
  UNION ALL SELECT 'audit_processed', count(*) FROM decoded WHERE reason IS NULL""",
    "stream_tumbling_1h": _with(
        "clean",
        more={
            "kept": f"SELECT * FROM clean WHERE NOT ({_late(3600)})",
            "hourly": _summary("kept", 3600),
        },
    )
    + "SELECT * FROM hourly",
    "stream_closed_twice": _with(
        "clean",
        more={
            "kept": f"SELECT * FROM clean WHERE NOT ({_late(3600)})",
            "hourly": _summary("kept", 3600),
        },
    )
    + "SELECT * FROM hourly",
    "stream_balance": _with("clean")
    + f"""SELECT f.fate, count(c.fate) AS n FROM (VALUES ('sent'), ('waiting'), ('late')) f(fate) LEFT JOIN (
  SELECT CASE WHEN {_late(3600)} THEN 'late' WHEN {_bucket(3600)} + INTERVAL 1 HOUR + to_seconds(2)
  <= TIMESTAMP '2024-01-15 00:00:00' THEN 'sent' ELSE 'waiting' END AS fate FROM clean) c USING (fate) GROUP BY f.fate""",
    "stream_missed": _with(
        "clean",
        more={
            "missed": f"""SELECT * FROM clean WHERE NOT ({_late(3600)}) AND event_id % 2 = 1
  AND {_bucket(3600)} + INTERVAL 1 HOUR + to_seconds(2) <= TIMESTAMP '2024-01-15 00:00:00'""",
            "hourly": _summary("missed", 3600),
        },
    )
    + "SELECT * FROM hourly",
    "stream_missed_balance": _with("clean")
    + f"""SELECT f.fate, count(c.fate) AS n FROM (VALUES ('sent'), ('waiting'), ('late'), ('missed')) f(fate) LEFT JOIN (
  SELECT CASE WHEN {_late(3600)} THEN 'late' WHEN event_id % 2 = 1 AND {_bucket(3600)} + INTERVAL 1 HOUR + to_seconds(2)
  <= TIMESTAMP '2024-01-15 00:00:00' THEN 'missed' ELSE 'sent' END AS fate FROM clean) c USING (fate) GROUP BY f.fate""",
    "stream_first_deliveries": _with(
        "clean",
        more={
            "kept": f"SELECT * FROM clean WHERE NOT ({_late(3600)})",
            "hourly": _summary("kept", 3600),
        },
    )
    + "SELECT * FROM hourly",
    "stream_audit": _with("decoded")
    + """SELECT 'ingest.' || what AS metric, n FROM (SELECT count(*) AS offered, count(reason) AS rejected,
  count(*) - count(reason) AS accepted FROM decoded) UNPIVOT (n FOR what IN (offered, rejected, accepted))""",
    "stream_raw_to_feed": _with(
        "decoded",
        more={
            "kept": f"SELECT * FROM decoded WHERE reason IS NULL AND NOT ({_late(3600)})",
            "hourly": _summary("kept", 3600),
        },
    )
    + "SELECT * FROM hourly",
}
