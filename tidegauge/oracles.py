"""ANSI SQL for the queries, run by DuckDB on the same tables."""

from __future__ import annotations

_HOUR = 3600
_DAY = 24 * _HOUR
_AS_OF = "TIMESTAMP '2024-01-15 00:00:00'"


def _tel(message_id: str = "event_id", value: str = "value") -> str:
    return f"""tel AS (
  SELECT CAST({message_id} AS VARCHAR) AS message_id, CAST(user_id % 10 AS VARCHAR) AS sensor_id,
         event_type AS metric_name, {value} AS value, ts AS "timestamp", event_id
  FROM events)"""


def _scored(source: str = "tel", depth: int = 20) -> str:
    return f"""scored AS (
  SELECT *, (value - baseline_mean) / nullif(baseline_std, 0) AS z
  FROM (SELECT *, count(value) OVER w AS baseline_n, avg(value) OVER w AS baseline_mean,
               coalesce(stddev_samp(value) OVER w, 0.0) AS baseline_std
        FROM {source}
        WINDOW w AS (PARTITION BY sensor_id, metric_name ORDER BY "timestamp", message_id
                     ROWS BETWEEN {depth} PRECEDING AND 1 PRECEDING)))"""


def _windows(seconds: int, min_samples: int = 3, source: str = "tel", name: str = "win") -> str:
    return f"""{name} AS (
  SELECT sensor_id, metric_name, window_start,
         window_start + to_seconds({seconds}) AS window_end, count(value) AS sample_count,
         avg(value) AS mean, min(value) AS minimum, max(value) AS maximum,
         coalesce(stddev_samp(value), 0.0) AS std_dev, quantile_cont(value, 0.95) AS p95
  FROM (SELECT *, make_timestamp((epoch_us("timestamp") // {seconds * 1000000}) * {seconds * 1000000})
               AS window_start FROM {source})
  GROUP BY sensor_id, metric_name, window_start
  HAVING count(value) >= {min_samples})"""


def _anchored(seconds: int) -> str:
    width = seconds * 1000000
    return f"""win AS (
  SELECT sensor_id, metric_name, window_start,
         window_start + to_seconds({seconds}) AS window_end, count(value) AS sample_count,
         avg(value) AS mean, min(value) AS minimum, max(value) AS maximum,
         coalesce(stddev_samp(value), 0.0) AS std_dev, quantile_cont(value, 0.95) AS p95
  FROM (SELECT *, make_timestamp(CAST(anchor + {width} *
                 greatest(CAST(ceil((epoch_us("timestamp") - anchor) / {width}.0) AS BIGINT) - 1, 0)
               AS BIGINT)) AS window_start
        FROM (SELECT *, min(epoch_us("timestamp")) OVER (PARTITION BY sensor_id, metric_name)
                     AS anchor FROM tel))
  GROUP BY sensor_id, metric_name, window_start
  HAVING count(value) >= 3)"""


_WINDOW_COLUMNS = """sensor_id, metric_name, window_start, window_end, sample_count,
  round(mean, 6) AS mean, minimum, maximum, round(std_dev, 6) AS std_dev, round(p95, 6) AS p95"""


def _wscored(source: str = "win") -> str:
    return f"""wscored AS (
  SELECT *, (mean - baseline_mean) / nullif(baseline_std, 0) AS z
  FROM (SELECT *, count(mean) OVER w AS baseline_n, avg(mean) OVER w AS baseline_mean,
               coalesce(stddev_samp(mean) OVER w, 0.0) AS baseline_std
        FROM {source}
        WINDOW w AS (PARTITION BY sensor_id, metric_name ORDER BY window_start
                     ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)))"""


_CENTS = "round(value * 100)"


def _exact(value: str, digits: int) -> str:
    """printf rounds the exact binary value, ties to even."""
    return f"CAST(printf('%.{digits}f', {value}) AS DOUBLE)"


_ANOMALY = "baseline_n >= 10 AND baseline_std > 1e-9 AND abs(z) > 3.0"
_SPIKE = "baseline_n >= 5 AND baseline_std >= 1e-9 AND abs(z) > 3.0"
_RECORD_SEVERITY = "CASE WHEN abs(z) > 4.5 THEN 'CRITICAL' ELSE 'WARNING' END AS severity"
_WINDOW_SEVERITY = "CASE WHEN abs(z) > 6.0 THEN 'CRITICAL' ELSE 'WARNING' END AS severity"


def _flagged(ttl_seconds: int, source: str = "tel") -> str:
    """is_duplicate by walking each id's rows in time order."""
    ttl = ttl_seconds * 1000000
    return f"""numbered AS (
  SELECT *, epoch_us("timestamp") AS t,
         row_number() OVER (PARTITION BY message_id ORDER BY "timestamp", event_id) AS rn
  FROM {source}),
walk AS (
  SELECT message_id, rn, t AS last, false AS is_duplicate FROM numbered WHERE rn = 1
  UNION ALL
  SELECT n.message_id, n.rn, CASE WHEN n.t - w.last > {ttl} THEN n.t ELSE w.last END,
         n.t - w.last <= {ttl}
  FROM walk w JOIN numbered n ON n.message_id = w.message_id AND n.rn = w.rn + 1),
flagged AS (
  SELECT n.*, w.is_duplicate FROM numbered n JOIN walk w USING (message_id, rn))"""


def _fifths(time: str) -> str:
    """The trigger of each event, by the fifth of the span of ``time``."""
    return f"""dealt AS (
  SELECT event_id, CAST(least(floor((t - first) / greatest(1, last - first)::DOUBLE * 5), 4) AS INTEGER) AS trigger
  FROM (SELECT event_id, t, min(t) OVER () AS first, max(t) OVER () AS last
        FROM (SELECT event_id, epoch_us({time}) AS t FROM events)))"""


_MESSAGE_TIME = """CASE event_id % 25 WHEN 11 THEN ts - INTERVAL 330 MINUTE
  WHEN 6 THEN date_trunc('second', ts) ELSE ts END"""


def _arrived(ttl_seconds: int, source: str) -> str:
    """is_duplicate in the order of arrival: an accepted row of the id is close in time, before or after.
    ``source`` has a trigger."""
    return f"""numbered AS (
  SELECT *, epoch_us("timestamp") AS t,
         row_number() OVER (PARTITION BY message_id ORDER BY trigger, "timestamp", event_id) AS rn
  FROM {source}),
walk AS (
  SELECT message_id, rn, false AS is_duplicate, [t] AS kept FROM numbered WHERE rn = 1
  UNION ALL
  SELECT message_id, rn, near, CASE WHEN near THEN kept ELSE list_append(kept, t) END
  FROM (SELECT n.message_id, n.rn, n.t, w.kept,
          len(list_filter(w.kept, lambda a: abs(n.t - a) <= {ttl_seconds * 1000000})) > 0 AS near
        FROM walk w JOIN numbered n ON n.message_id = w.message_id AND n.rn = w.rn + 1)),
flagged AS (
  SELECT n.*, w.is_duplicate FROM numbered n JOIN walk w USING (message_id, rn))"""


def _raw(message_id: str = "event_id") -> str:
    return f"""texts AS (
  SELECT event_id, ts AS received_at, event_id % 25 AS fault,
         '{{"message_id":"' || CAST({message_id} AS VARCHAR) || '","sensor_id":"'
         || CAST(user_id % 10 AS VARCHAR) || '","metric_name":"' || event_type || '","value":'
         || CASE event_id % 25 WHEN 2 THEN '"COMM_ERROR"' WHEN 3 THEN 'null' WHEN 5 THEN '"nan"'
              WHEN 7 THEN '"' || printf('%.2f', value) || '"' WHEN 9 THEN 'true'
              WHEN 14 THEN '"-Infinity"' ELSE printf('%.2f', value) END
         || ',' || CASE event_id % 25 WHEN 12 THEN '' ELSE '"unit":"u",' END || '"timestamp":'
         || CASE event_id % 25 WHEN 4 THEN '"not-a-date"'
              WHEN 6 THEN CAST(epoch_us(ts) // 1000000 AS VARCHAR)
              WHEN 10 THEN '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z"'
              WHEN 11 THEN '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30"'
              ELSE '"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '"' END
         || ',"tags":' || props || '}}' AS body
  FROM events),
messages AS (
  SELECT event_id, received_at,
         CASE fault WHEN 0 THEN 'this is not json at all }}{{' WHEN 1 THEN '{{}}'
           WHEN 8 THEN '[1, 2]' WHEN 13 THEN body || ' tail' ELSE body END AS raw
  FROM texts)"""


# Text functions of JSON are guarded, since DuckDB raises an error on malformed text.
_PARSED = """typed AS (
  SELECT *, json_valid(raw) AS ok,
         CASE WHEN json_valid(raw) THEN CAST(raw AS JSON) END AS doc FROM messages),
fields AS (
  SELECT *, json_type(doc) AS kind, json_type(doc, '$.value') AS value_kind,
         json_type(doc, '$.timestamp') AS time_kind, doc ->> '$.value' AS value_text,
         doc ->> '$.timestamp' AS time_text,
         list_filter(['message_id', 'metric_name', 'sensor_id', 'timestamp', 'unit', 'value'],
                     lambda k: NOT coalesce(json_exists(doc, '$.' || k), false)) AS missing
  FROM typed),
valued AS (
  SELECT *, CASE WHEN value_kind = 'BOOLEAN' THEN CASE value_text WHEN 'true' THEN 1.0 ELSE 0.0 END
                 WHEN value_kind IN ('NULL', 'OBJECT', 'ARRAY') THEN NULL
                 ELSE TRY_CAST(value_text AS DOUBLE) END AS number,
         CASE WHEN time_kind = 'VARCHAR'
                THEN CASE WHEN regexp_matches(time_text, '[+-][0-9]{2}:[0-9]{2}$')
                          THEN TRY_CAST(regexp_replace(time_text, '[+-][0-9]{2}:[0-9]{2}$', '')
                                        AS TIMESTAMP)
                               - to_seconds(CASE WHEN time_text[-6] = '-' THEN -1 ELSE 1 END
                                   * (CAST(time_text[-5:-4] AS BIGINT) * 3600
                                      + CAST(time_text[-2:] AS BIGINT) * 60))
                          ELSE TRY_CAST(regexp_replace(time_text, 'Z$', '') AS TIMESTAMP) END
              WHEN time_kind IN ('BIGINT', 'UBIGINT', 'DOUBLE')
                THEN make_timestamp(CAST(CAST(time_text AS DOUBLE) * 1000000 AS BIGINT)) END AS instant
  FROM fields),
parsed AS (
  SELECT *, CASE WHEN NOT ok THEN 'JSON_PARSE' WHEN kind <> 'OBJECT' THEN 'NOT_OBJECT'
                 WHEN len(missing) > 0 THEN 'MISSING_FIELDS' WHEN number IS NULL THEN 'NON_NUMERIC'
                 WHEN NOT isfinite(number) THEN 'NON_FINITE'
                 WHEN instant IS NULL THEN 'BAD_TIMESTAMP' END AS reason_code
  FROM valued),
valid AS (
  SELECT event_id, doc ->> '$.message_id' AS message_id, doc ->> '$.sensor_id' AS sensor_id,
         doc ->> '$.metric_name' AS metric_name, number AS value, doc ->> '$.unit' AS unit,
         instant AS "timestamp", doc
  FROM parsed WHERE reason_code IS NULL)"""


def _with(*parts: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n"


def _both_alerts() -> str:
    return f"""SELECT sensor_id, metric_name, 'zscore' AS anomaly_type, "timestamp" AS detected_at,
  round(value, 6) AS observed_value, {_exact("z", 3)} AS zscore, {_RECORD_SEVERITY}
FROM scored WHERE {_ANOMALY}
UNION ALL
SELECT sensor_id, metric_name, 'value_spike', window_end, {_exact("mean", 4)},
  {_exact("z", 3)}, {_WINDOW_SEVERITY} FROM wscored WHERE {_SPIKE}"""


def _end_to_end(*more: str) -> str:
    return _with(
        _raw("user_id"),
        _PARSED,
        _flagged(_DAY, "valid"),
        "tel2 AS (SELECT * FROM flagged WHERE NOT is_duplicate)",
        *more,
        recursive=True,
    )


def all_oracles() -> dict[str, str]:
    sql: dict[str, str] = {}
    scores = """SELECT message_id, sensor_id, metric_name, "timestamp", value, baseline_n,
  round(baseline_mean, 6) AS baseline_mean, round(baseline_std, 6) AS baseline_std,
  round(z, 6) AS z FROM scored"""
    sql["zscore_baseline"] = _with(_tel(), _scored()) + scores
    sql["zscore_baseline_sliced"] = sql["zscore_baseline"]
    anomalies = f"""SELECT sensor_id, metric_name, "timestamp" AS detected_at,
  value AS observed_value, round(baseline_mean, 6) AS baseline_mean,
  round(baseline_std, 6) AS baseline_std, round(z, 6) AS zscore, {_RECORD_SEVERITY} FROM scored"""
    sql["zscore_alerts"] = _with(_tel(), _scored()) + f"{anomalies} WHERE {_ANOMALY}"
    sql["zscore_alerts_tuned"] = (
        _with(_tel(), _scored(depth=30))
        + anomalies.replace("4.5", "3.0")
        + " WHERE baseline_n >= 5 AND baseline_std > 1e-9 AND abs(z) > 2.0"
    )
    rows = f"""SELECT sensor_id, metric_name, 'zscore' AS anomaly_type,
  "timestamp" AS detected_at, value AS observed_value,
  {_exact("baseline_mean", 4)} AS baseline_mean, {_exact("baseline_std", 4)} AS baseline_std,
  {_exact("z", 3)} AS zscore,
  printf('Value %.4f deviates %+.2fσ from baseline μ=%.4f σ=%.4f', value, z, baseline_mean,
         baseline_std) AS message, {_RECORD_SEVERITY} FROM scored WHERE {_ANOMALY}"""
    sql["record_alert_rows"] = _with(_tel(value=_CENTS), _scored()) + rows
    sql["record_alert_lines"] = (
        _with(_tel(value=_CENTS), _scored(), f"alerts AS ({rows})")
        + """SELECT 'ALERT  | [' || severity || '] ZSCORE sensor=' || sensor_id || ' metric='
  || metric_name || ' value=' || CAST(observed_value AS VARCHAR) || ' z='
  || printf('%.2f', zscore) || ' at '
  || CASE WHEN epoch_us(detected_at) % 1000000 = 0
          THEN strftime(detected_at, '%Y-%m-%dT%H:%M:%S')
          ELSE strftime(detected_at, '%Y-%m-%dT%H:%M:%S.%f') END AS line FROM alerts"""
    )

    def window_query(*parts: str, where: str = "") -> str:
        return _with(*parts) + f"SELECT {_WINDOW_COLUMNS} FROM win {where}"

    sql["window_stats_six_hours"] = window_query(_tel(), _windows(6 * _HOUR))
    sql["window_stats_daily"] = window_query(_tel(), _windows(_DAY))
    sql["window_stats_sliced"] = sql["window_stats_daily"]
    sql["window_stats_minute"] = window_query(_tel(), _windows(60, min_samples=1))
    sql["window_stats_anchored"] = window_query(_tel(), _anchored(_DAY))
    sql["window_stats_as_of"] = window_query(
        _tel(), _anchored(_DAY), where=f"WHERE window_end <= {_AS_OF}"
    )
    sql["window_assignment"] = _with(_tel()) + """SELECT message_id,
  sensor_id || '::' || metric_name AS window_key,
  time_bucket(INTERVAL '6 hours', "timestamp") AS window_start,
  time_bucket(INTERVAL '6 hours', "timestamp") + INTERVAL '6 hours' AS window_end FROM tel"""
    sql["window_lines"] = _with(_tel(value=_CENTS), _windows(_DAY)) + """SELECT sensor_id, metric_name,
  window_start, 'WINDOW | ' || sensor_id || '::' || metric_name || ' n='
  || CAST(sample_count AS VARCHAR) || ' mean=' || printf('%.4f', mean) || ' p95='
  || printf('%.4f', p95) || ' [' || strftime(window_start, '%H:%M:%S') || '–'
  || strftime(window_end, '%H:%M:%S') || ']' AS line FROM win"""
    shares = ", ".join(
        f"round(quantile_cont(value, {p}), 6) AS {n}"
        for n, p in (("p05", 0.05), ("p50", 0.5), ("p95", 0.95), ("p99", 0.99))
    )
    sql["series_percentiles"] = (
        _with(_tel()) + f"SELECT sensor_id, metric_name, {shares} FROM tel GROUP BY ALL"
    )
    sql["series_percentiles_sliced"] = sql["series_percentiles"]
    sql["price_percentiles"] = """SELECT l_returnflag, l_linestatus,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
  round(quantile_cont(l_extendedprice, 0.95), 6) AS p95 FROM lineitem GROUP BY 1, 2"""
    sql["whole_series_stats"] = _with(_tel()) + """SELECT sensor_id, metric_name,
  count(value) AS n, round(avg(value), 6) AS mean,
  round(coalesce(var_samp(value), 0.0), 6) AS variance,
  round(coalesce(stddev_samp(value), 0.0), 6) AS std FROM tel GROUP BY 1, 2"""
    sql["running_moments"] = _with(_tel()) + """SELECT message_id,
  count(value) OVER w AS running_n, round(avg(value) OVER w * count(value) OVER w, 4) AS running_sum,
  round(coalesce(stddev_samp(value) OVER w, 0.0), 6) AS running_std FROM tel
WINDOW w AS (PARTITION BY sensor_id, metric_name ORDER BY "timestamp", message_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    sql["running_moments_sliced"] = sql["running_moments"]

    sql["window_alert_rows"] = (
        _with(_tel(value=_CENTS), _windows(6 * _HOUR), _wscored())
        + f"""SELECT sensor_id, metric_name, 'value_spike' AS anomaly_type, window_end AS detected_at,
  {_exact("mean", 4)} AS observed_value, {_exact("baseline_mean", 4)} AS baseline_mean,
  {_exact("baseline_std", 4)} AS baseline_std, {_exact("z", 3)} AS zscore,
  printf('Window mean %.4f deviates %+.2fσ from %d-window baseline μ=%.4f', mean, z, baseline_n,
         baseline_mean) AS message, {_WINDOW_SEVERITY} FROM wscored WHERE {_SPIKE}"""
    )
    spikes = f"""SELECT sensor_id, metric_name, window_end AS detected_at,
  round(mean, 6) AS observed_value, baseline_n, round(baseline_mean, 6) AS baseline_mean,
  round(baseline_std, 6) AS baseline_std, round(z, 6) AS zscore, {_WINDOW_SEVERITY}
FROM wscored WHERE {_SPIKE}"""
    sql["window_spikes_six_hours"] = _with(_tel(), _windows(6 * _HOUR), _wscored()) + spikes
    sql["window_spikes_daily"] = _with(_tel(), _windows(_DAY), _wscored()) + spikes
    sql["all_alerts"] = _with(_tel(), _scored(), _windows(6 * _HOUR), _wscored()) + _both_alerts()

    def dedup(ttl: int) -> str:
        return _with(_tel("user_id"), _flagged(ttl), recursive=True)

    flags = "SELECT event_id, message_id, is_duplicate FROM flagged"
    records = """SELECT event_id, message_id, sensor_id, metric_name, value, "timestamp"
FROM flagged WHERE """
    sql["dedup_flagged"] = dedup(_DAY) + flags
    sql["dedup_flagged_chain"] = sql["dedup_flagged"]
    sql["dedup_short_ttl"] = dedup(_HOUR) + flags
    sql["dedup_accepted"] = dedup(_DAY) + records + "NOT is_duplicate"
    sql["dedup_duplicates"] = dedup(_DAY) + records + "is_duplicate"
    sql["dedup_statistics"] = dedup(_DAY) + f"""SELECT count(*) AS total_seen,
  count(*) FILTER (is_duplicate) AS total_dupes,
  CAST(printf('%.2f', 100.0 * count(*) FILTER (is_duplicate) / greatest(count(*), 1)) AS DOUBLE)
    AS dupe_rate_pct,
  count(*) FILTER (NOT is_duplicate AND t >= (SELECT max(t) FROM numbered) - {_DAY * 1000000})
    AS cache_size FROM flagged"""

    sql["parse_valid"] = _with(_raw(), _PARSED) + """SELECT event_id, message_id, sensor_id,
  metric_name, value, unit, "timestamp" FROM valid"""
    sql["parse_tags"] = _with(_raw(), _PARSED) + """SELECT event_id, doc ->> '$.tags.k' AS k,
  CAST(doc ->> '$.tags.k' AS BIGINT) AS k_number FROM valid"""
    sql["parse_dead_letters"] = _with(_raw(), _PARSED) + """SELECT raw[:500] AS raw_payload,
  CASE reason_code WHEN 'JSON_PARSE' THEN 'JSON parse error: malformed text'
    WHEN 'NOT_OBJECT' THEN 'Payload is not a JSON object'
    WHEN 'MISSING_FIELDS' THEN 'Missing fields: {'
      || array_to_string(list_transform(missing, lambda k: '''' || k || ''''), ', ') || '}'
    WHEN 'NON_NUMERIC' THEN 'Non-numeric value: ' || CASE value_kind WHEN 'VARCHAR'
      THEN '''' || value_text || '''' ELSE 'None' END
    WHEN 'NON_FINITE' THEN 'Non-finite value: ' || CASE WHEN isnan(number) THEN 'nan'
      WHEN number > 0 THEN 'inf' ELSE '-inf' END
    ELSE 'Unparseable timestamp: ''' || time_text || '''' END AS reason,
  reason_code, received_at FROM parsed WHERE reason_code IS NOT NULL"""
    sql["parse_outcomes"] = _with(_raw(), _PARSED) + """SELECT
  coalesce(reason_code, 'VALID') AS outcome, count(*) AS n FROM parsed GROUP BY 1"""
    sql["source_decoded_rows"] = _with(_raw(), _PARSED) + """SELECT CAST(event_id % 3 AS INTEGER) AS "partition",
  event_id AS "offset", message_id, sensor_id, metric_name, value, "timestamp" FROM valid"""
    sql["source_text_outcomes"] = sql["parse_outcomes"]
    sql["source_parquet_outcomes"] = _with(_raw(), _PARSED) + """SELECT
  coalesce(reason_code, 'VALID') AS outcome, count(*) AS n, min(event_id) AS first_event FROM parsed GROUP BY 1"""
    sql["parse_page_markup"] = """SELECT page_id, 'JSON_PARSE' AS reason_code,
  html[:500] AS raw_payload FROM pages"""
    sql["record_ages"] = _with(_tel()) + """SELECT message_id,
  round((epoch_us(TIMESTAMP '2024-02-01 00:00:00') - epoch_us("timestamp")) / 1000000.0, 6)
    AS age_seconds FROM tel"""

    sql["aggregator_statistics"] = _with(_tel(), _windows(_DAY)) + """SELECT
  (SELECT count(*) FROM (SELECT DISTINCT sensor_id, metric_name FROM tel)) AS active_keys,
  (SELECT count(*) FROM win) AS total_windows_flushed"""
    sql["aggregator_buffers"] = _with(_tel()) + """SELECT sensor_id || '::' || metric_name AS window_key,
  count(*) FILTER (epoch_us("timestamp") - epoch_us("timestamp") % 21600000000 + 21600000000
    > epoch_us(TIMESTAMP '2024-01-15 05:30:00')) AS buffer_size
FROM tel WHERE "timestamp" <= TIMESTAMP '2024-01-15 05:30:00' GROUP BY 1"""
    sql["detector_statistics"] = _with(_tel(), _scored(), _windows(6 * _HOUR)) + f"""SELECT
  (SELECT count(*) FROM (SELECT DISTINCT sensor_id, metric_name FROM tel)) AS tracked_keys,
  (SELECT count(*) FROM (SELECT DISTINCT sensor_id, metric_name FROM win)) AS window_tracked_keys,
  (SELECT count(*) FROM scored WHERE {_ANOMALY}) AS total_alerts"""

    tail = (_scored("tel2"), _windows(_DAY, source="tel2"), _wscored())
    sql["end_to_end_alerts"] = _end_to_end(*tail) + _both_alerts()
    sql["end_to_end_windows"] = _end_to_end(*tail) + f"SELECT {_WINDOW_COLUMNS} FROM win"
    sql["end_to_end_records"] = _end_to_end() + """SELECT event_id, message_id, sensor_id,
  metric_name, value, "timestamp" FROM tel2"""
    sql["end_to_end_counters"] = _end_to_end(
        *tail,
        f"raised AS ({_both_alerts()})",
        """c AS (SELECT (SELECT count(*) FROM parsed) AS received,
  (SELECT count(*) FROM parsed WHERE reason_code IS NOT NULL) AS malformed,
  (SELECT count(*) FROM flagged WHERE is_duplicate) AS dupes,
  (SELECT count(*) FROM tel2) AS processed, (SELECT count(*) FROM raised) AS alerts)""",
    ) + """SELECT *,
  CAST(printf('%.2f', 100.0 * malformed / greatest(received, 1)) AS DOUBLE) AS malformed_pct,
  CAST(printf('%.2f', 100.0 * dupes / greatest(received, 1)) AS DOUBLE) AS dupes_pct FROM c"""

    # A drained stream has closed the windows that end by its newest event (in milliseconds).
    newest = """(SELECT date_trunc('milliseconds', max("timestamp")) FROM {source})"""
    closed = "closed AS (SELECT * FROM win WHERE window_end <= " + newest + ")"
    sql["stream_dedup"] = sql["dedup_flagged"]
    sql["stream_dedup_within_watermark"] = (
        "SELECT DISTINCT CAST(user_id AS VARCHAR) AS message_id FROM events"
    )
    sql["stream_zscore_baseline"] = sql["zscore_baseline"]
    sql["stream_zscore_by_trigger"] = sql["zscore_baseline"]
    sql["stream_window_stats"] = (
        _with(_tel(), _windows(_DAY), closed.format(source="tel"))
        + f"SELECT {_WINDOW_COLUMNS} FROM closed"
    )
    published_spikes = f"""SELECT sensor_id, metric_name, 'value_spike' AS anomaly_type,
  window_end AS detected_at, {_exact("mean", 4)} AS observed_value, {_exact("z", 3)} AS zscore,
  {_WINDOW_SEVERITY} FROM wscored WHERE {_SPIKE}"""
    sql["stream_window_spikes"] = (
        _with(_tel(), _windows(_DAY), closed.format(source="tel"), _wscored("closed"))
        + published_spikes
    )
    sql["stream_anchored_windows"] = (
        _with(_tel(), _anchored(_DAY), """closed AS (SELECT * FROM win
  WHERE window_end <= (SELECT max("timestamp") FROM tel))""")
        + f"SELECT {_WINDOW_COLUMNS} FROM closed"
    )
    for name, same in (
        ("stream_anchored_five_triggers", "stream_anchored_windows"),
        ("stream_anchored_keyed_state", "stream_anchored_windows"),
        ("stream_windows_five_triggers", "stream_window_stats"),
        ("stream_zscore_five_triggers", "zscore_baseline"),
        ("stream_zscore_keyed_state", "zscore_baseline"),
        ("stream_dedup_five_triggers", "dedup_flagged"),
        ("stream_dedup_keyed_state", "dedup_flagged"),
    ):
        sql[name] = sql[same]
    unique = _with(_raw(), _PARSED)
    sql["stream_late_records"] = unique + """SELECT event_id, message_id, sensor_id, metric_name,
  value, "timestamp" FROM valid"""
    sql["stream_restart_records"] = sql["stream_late_records"]
    sql["stream_late_counters"] = unique + """SELECT (SELECT count(*) FROM parsed) AS received,
  (SELECT count(*) FROM parsed WHERE reason_code IS NOT NULL) AS malformed, 0 AS dupes,
  count(*) AS processed,
  count(*) FILTER (time_bucket(INTERVAL '1 day', "timestamp") + INTERVAL '1 day' <= clock) AS late
FROM valid LEFT JOIN (
  SELECT trigger, max(newest) OVER (ORDER BY trigger ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock
  FROM (SELECT event_id % 5 AS trigger, max("timestamp") AS newest FROM valid GROUP BY 1)
) ON event_id % 5 = trigger"""
    sql["stream_end_to_end_alerts"] = (
        _end_to_end(
            _scored("tel2"),
            _windows(_DAY, source="tel2"),
            closed.format(source="tel2"),
            _wscored("closed"),
        )
        + _both_alerts()
    )
    sql["stream_end_to_end_five_triggers"] = sql["stream_end_to_end_alerts"]
    sql["stream_end_to_end_windows"] = (
        _end_to_end(_windows(_DAY, source="tel2"), closed.format(source="tel2")) + f"SELECT {_WINDOW_COLUMNS} FROM closed"
    )
    sql["stream_running_moments"] = sql["running_moments"]
    sql["stream_dedup_out_of_order"] = (
        _with(
            _tel("user_id"), "sent AS (SELECT *, event_id % 5 AS trigger FROM tel)", _arrived(_DAY, "sent"), recursive=True
        )
        + flags
    )
    # The reading of 2099 is in no closed window, and the others close as without it.
    sql["stream_windows_future_reading"] = (
        _with(
            _tel(),
            "others AS (SELECT * FROM tel WHERE event_id <> (SELECT min(event_id) FROM tel))",
            _windows(_DAY, source="others"),
            closed.format(source="others"),
        )
        + f"SELECT {_WINDOW_COLUMNS} FROM closed"
    )
    sql["window_stats_sketched"] = _with(_tel(), _windows(_DAY)) + """SELECT sensor_id, metric_name, window_start,
  sample_count, true AS within_bound FROM win"""
    # Late is what is not after the newest time of the triggers before, in milliseconds, less the time-to-live.
    sql["stream_watermark_drops"] = _with(
        _tel(),
        "sent AS (SELECT *, event_id % 5 AS trigger FROM tel)",
        f"""marks AS (
  SELECT trigger, max(newest) OVER (ORDER BY trigger ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    - INTERVAL '{_DAY} seconds' AS mark
  FROM (SELECT trigger, date_trunc('milliseconds', max("timestamp")) AS newest FROM sent GROUP BY 1))""",
    ) + """SELECT count(*) AS received, count(*) FILTER ("timestamp" <= mark) AS dropped,
  count(*) FILTER (mark IS NULL OR "timestamp" > mark) AS kept FROM sent JOIN marks USING (trigger)"""
    sql["stream_end_to_end_arrival_order"] = _arrival_order()
    sql["stream_statistics_five_triggers"] = _statistics()
    return sql


def _arrival_order() -> str:
    scored = _scored("tel2").replace('ORDER BY "timestamp"', 'ORDER BY trigger, "timestamp"')
    return _with(
        _raw("user_id"),
        _PARSED,
        _fifths("ts"),
        "sent AS (SELECT v.*, d.trigger FROM valid v JOIN dealt d USING (event_id))",
        _arrived(_DAY, "sent"),
        "tel2 AS (SELECT * FROM flagged WHERE NOT is_duplicate)",
        scored,
        # a row whose window had closed before its trigger is in no window
        """clocks AS (
  SELECT trigger, max(newest) OVER (ORDER BY trigger ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS clock
  FROM (SELECT trigger, max("timestamp") AS newest FROM tel2 GROUP BY 1)),
timely AS (
  SELECT t.* FROM tel2 t JOIN clocks c USING (trigger)
  WHERE c.clock IS NULL
    OR time_bucket(INTERVAL '1 day', t."timestamp") + INTERVAL '1 day' > c.clock)""",
        _windows(_DAY, source="timely"),
        """closed AS (SELECT * FROM win WHERE window_end <= (SELECT max("timestamp") FROM tel2))""",
        _wscored("closed"),
        recursive=True,
    ) + _both_alerts()


def _statistics() -> str:
    return _end_to_end(
        _fifths(_MESSAGE_TIME),
        "seen AS (SELECT f.*, d.trigger FROM flagged f JOIN dealt d USING (event_id))",
        _scored("tel2"),
        _windows(_DAY, source="tel2"),
        f"""turns AS (
  SELECT d.trigger AS n, (SELECT max(t) FROM seen WHERE trigger <= d.trigger AND NOT is_duplicate) AS now
  FROM (SELECT DISTINCT trigger FROM dealt) d),
rows_so_far AS (
  SELECT n, count(*) AS total_seen, count(*) FILTER (is_duplicate) AS total_dupes,
    count(*) FILTER (NOT is_duplicate AND t BETWEEN now - {_DAY * 1000000} AND now) AS cache_size,
    count(DISTINCT sensor_id || '::' || metric_name) FILTER (NOT is_duplicate) AS active_keys,
    count(*) FILTER (NOT is_duplicate AND t // {_DAY * 1000000} * {_DAY * 1000000} + {_DAY * 1000000} > now)
      AS waiting_rows
  FROM turns JOIN seen ON seen.trigger <= n GROUP BY 1),
windows_so_far AS (
  SELECT n, count(win.window_start) AS total_windows_flushed,
    count(DISTINCT sensor_id || '::' || metric_name) AS window_tracked_keys
  FROM turns LEFT JOIN win ON epoch_us(window_end) <= now GROUP BY 1),
alerts_so_far AS (
  SELECT n, count(s.event_id) AS total_alerts FROM turns LEFT JOIN (
    SELECT s.event_id, d.trigger FROM scored s JOIN dealt d USING (event_id) WHERE {_ANOMALY}
  ) s ON s.trigger <= n GROUP BY 1)""",
    ) + """SELECT n AS batch_id, total_seen, total_dupes, cache_size, active_keys, waiting_rows,
  total_windows_flushed, active_keys AS tracked_keys, window_tracked_keys, total_alerts,
  round(100.0 * total_dupes / greatest(total_seen, 1), 2) AS dupe_rate_pct
FROM rows_so_far JOIN windows_so_far USING (n) JOIN alerts_so_far USING (n)"""
