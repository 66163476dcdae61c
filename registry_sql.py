"""The same results in DuckDB SQL, worded independently of the Spark code.

Averages and other quotients are rounded half up in integer arithmetic, so that no value
depends on how an engine divides. Results use plain types as in ``registry``.
"""

from __future__ import annotations

USAGE = """
usage AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
    concat('77', lpad(CAST(user_id AS VARCHAR), 5, '0'), '****') AS msisdn,
    CASE event_type WHEN 'click' THEN 'call' WHEN 'view' THEN 'data_session'
      WHEN 'purchase' THEN 'balance_recharge' WHEN 'error' THEN 'sms'
      ELSE 'service_activation' END AS event_type,
    CASE WHEN event_type IN ('click', 'error')
        THEN CASE WHEN event_id % 2 = 0 THEN 'incoming' ELSE 'outgoing' END
      WHEN event_type = 'signup' THEN concat('Service_', CAST(event_id % 5 AS VARCHAR))
      END AS event_subtype,
    CASE WHEN event_type = 'click' THEN CAST(floor(value * 60) AS INT)
      WHEN event_type = 'view' THEN CAST(floor(value * 10) AS INT) END AS duration_seconds,
    CASE WHEN event_type = 'view'
      THEN CAST(CAST(value AS DECIMAL(10,2)) * 20 AS DECIMAL(18,2)) END AS data_mb,
    CASE WHEN event_type = 'purchase'
      THEN CAST(CAST(value AS DECIMAL(10,2)) * 200 AS DECIMAL(18,2)) END AS amount,
    CASE WHEN event_id % 101 = 0 THEN NULL
      ELSE concat('Region_', lpad(CAST(user_id % 12 AS VARCHAR), 2, '0')) END AS region,
    CAST(1000 + event_id % 9000 AS INT) AS cell_tower_id,
    ts AS event_time
  FROM events)"""

WIRE = (
    USAGE
    + """,
wire AS (
  SELECT event_id, CASE WHEN k % 89 = 0 THEN '' ELSE msisdn END AS msisdn,
    CASE WHEN k % 83 = 0 THEN 'unknown' ELSE event_type END AS event_type, event_subtype,
    CASE WHEN k % 97 = 0 THEN -1 ELSE duration_seconds END AS duration_seconds,
    CASE WHEN k % 79 = 0 THEN CAST(-1 AS DECIMAL(18,2)) ELSE data_mb END AS data_mb,
    CASE WHEN k % 73 = 0 THEN CAST(-1 AS DECIMAL(18,2)) ELSE amount END AS amount,
    region, cell_tower_id, event_time
  FROM (SELECT *, CAST(event_id AS BIGINT) AS k,
          unnest(range(CASE WHEN CAST(event_id AS BIGINT) % 50 = 0 THEN 2 ELSE 1 END)) AS copy
        FROM usage)),
valid AS (
  SELECT * FROM wire
  WHERE event_type IN ('call', 'sms', 'data_session', 'balance_recharge', 'service_activation')
    AND NOT coalesce(duration_seconds < 0, FALSE) AND NOT coalesce(data_mb < 0, FALSE)
    AND NOT coalesce(amount < 0, FALSE) AND length(msisdn) > 0)"""
)


def half_up(num: str, den: str, scale: int) -> str:
    """num / den for whole, non-negative num and den, rounded half up; NULL for den = 0."""
    p = 10**scale
    return (
        f"CAST((2 * {p} * CAST({num} AS HUGEINT) + CAST({den} AS HUGEINT))"
        f" // NULLIF(2 * CAST({den} AS HUGEINT), 0) AS DOUBLE) / CAST({p} AS DOUBLE)"
    )


def cents(column: str) -> str:
    return f"SUM(CAST({column} * 100 AS BIGINT))"


def double(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


EVENT_COLUMNS = (
    "event_id, msisdn, event_type, event_subtype, CAST(duration_seconds AS DOUBLE) AS duration_seconds,"
    " CAST(data_mb AS DOUBLE) AS data_mb, CAST(amount AS DOUBLE) AS amount, region, cell_tower_id,"
    " event_time AS timestamp"
)

TOTALS = f"""count(*) AS count_events,
  CAST(coalesce(SUM(duration_seconds), 0) AS DOUBLE) AS total_duration_seconds,
  {half_up(f"coalesce({cents('data_mb')}, 0)", "102400", 4)} AS total_data_gb,
  {double("coalesce(SUM(amount), 0)")} AS total_amount"""
AVERAGES = f"""
  {half_up("SUM(duration_seconds)", "count(duration_seconds)", 2)} AS avg_duration_seconds,
  {half_up(cents("data_mb"), "100 * count(data_mb)", 2)} AS avg_data_mb"""
NO_AVERAGES = "CAST(NULL AS DOUBLE) AS avg_duration_seconds, CAST(NULL AS DOUBLE) AS avg_data_mb"


def window_metrics(
    minutes: int,
    tag: str,
    keys: tuple[str, ...],
    averages: str,
    having: str = "",
    slide: int = 0,
    rows: str = "usage",
    tables: str = USAGE,
) -> str:
    region = "region" if "region" in keys else "CAST(NULL AS VARCHAR) AS region"
    subtype = "event_subtype" if "event_subtype" in keys else "CAST(NULL AS VARCHAR) AS event_subtype"
    source = f"(SELECT *, 0 AS shift FROM {rows})"
    start = f"time_bucket(INTERVAL '{minutes} minutes', event_time)"
    if slide:
        # Each event lies in size/slide windows, which start 0, 1, .. slides before its pane.
        source = f"(SELECT *, unnest(range({minutes // slide})) AS shift FROM {rows})"
        start = (
            f"(time_bucket(INTERVAL '{slide} minutes', event_time)"
            f" - shift * INTERVAL '{slide} minutes')"
        )
    return f"""WITH {tables}
SELECT {start} AS window_start, {start} + INTERVAL '{minutes} minutes' AS window_end,
  '{tag}' AS metric_type, {region}, event_type, {subtype}, {TOTALS}, {averages}
FROM {source} GROUP BY {start}, {", ".join(keys)} {having}"""


def closed(minutes: int) -> str:
    """Windows a stream has emitted: their end is not after the final watermark."""
    return (
        f"HAVING time_bucket(INTERVAL '{minutes} minutes', event_time) + INTERVAL '{minutes} minutes'"
        " <= (SELECT max(event_time) - INTERVAL '1 minute' FROM usage)"
    )


TYPE_KEYS = ("event_type", "event_subtype")
REGION_KEYS = ("region", "event_type")

ANOMALIES = """
anomalies_found AS (
  SELECT event_id, msisdn,
    CASE WHEN duration_seconds > 14400 THEN 'excessive_call_duration'
      WHEN data_mb > 5000 THEN 'excessive_data_usage'
      WHEN amount > 50000 THEN 'excessive_recharge' ELSE 'unknown' END AS anomaly_type,
    CASE WHEN duration_seconds > 14400 THEN 'Call duration: ' || duration_seconds || ' seconds'
      WHEN data_mb > 5000 THEN 'Data usage: ' || data_mb || ' MB'
      WHEN amount > 50000 THEN 'Recharge amount: ' || amount || ' tenge'
      ELSE 'Unknown anomaly' END AS anomaly_reason,
    'high' AS severity, event_time AS detected_at
  FROM usage
  WHERE (event_type = 'call' AND duration_seconds > 14400)
    OR (event_type = 'data_session' AND data_mb > 5000)
    OR (event_type = 'balance_recharge' AND amount > 50000))"""

DAILY = f"""
daily AS (
  SELECT CAST(event_time AS DATE) AS date, region, event_type,
    count(*) AS total_events,
    count(*) FILTER (WHERE event_type = 'call') AS total_calls,
    count(*) FILTER (WHERE event_type = 'sms') AS total_sms,
    count(*) FILTER (WHERE event_type = 'data_session') AS total_data_sessions,
    CAST(SUM(duration_seconds) FILTER (WHERE event_type = 'call') AS DOUBLE) AS total_call_duration,
    CASE WHEN event_type = 'call' THEN
      {half_up("SUM(duration_seconds)", "count(duration_seconds)", 2)} END AS avg_call_duration,
    CAST(MAX(duration_seconds) FILTER (WHERE event_type = 'call') AS DOUBLE) AS max_call_duration,
    SUM(data_mb) AS total_data_mb,
    {half_up(cents("data_mb"), "100 * count(data_mb)", 2)} AS avg_data_mb,
    MAX(data_mb) AS max_data_mb,
    SUM(amount) AS total_revenue,
    {half_up(cents("amount"), "100 * count(amount)", 2)} AS avg_transaction
  FROM usage GROUP BY CAST(event_time AS DATE), region, event_type)"""

HOURLY = f"""
hourly AS (
  SELECT date_trunc('hour', event_time) AS hour_timestamp, region, event_type,
    count(*) AS total_events,
    CAST(SUM(coalesce(duration_seconds, 0)) AS BIGINT) AS total_duration,
    {half_up("SUM(duration_seconds)", "count(duration_seconds)", 2)} AS avg_duration,
    SUM(coalesce(data_mb, 0)) AS total_data_mb,
    SUM(coalesce(amount, 0)) AS total_amount
  FROM usage GROUP BY ALL)"""

CONDITIONAL = f"""
conditional AS (
  SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start,
    time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' AS window_end,
    '5min' AS metric_type, region, event_type, CAST(NULL AS VARCHAR) AS event_subtype,
    count(*) AS count_events, CAST(NULL AS DOUBLE) AS total_duration_seconds,
    {half_up(f"coalesce({cents('data_mb')} FILTER (WHERE event_type = 'data_session'), 0)", "102400", 4)}
      AS total_data_gb,
    {double("coalesce(SUM(amount) FILTER (WHERE event_type = 'balance_recharge'), 0)")} AS total_amount,
    {half_up(f"coalesce({cents('data_mb')} FILTER (WHERE event_type = 'data_session'), 0)",
             "100 * count(*)", 2)} AS avg_data_mb,
    CASE WHEN event_type = 'call' THEN
      CAST(count(*) FILTER (WHERE event_subtype = 'incoming') AS DOUBLE) END AS incoming_calls,
    CASE WHEN event_type = 'call' THEN
      CAST(count(*) FILTER (WHERE event_subtype = 'outgoing') AS DOUBLE) END AS outgoing_calls,
    count(*) FILTER (WHERE event_type = 'sms') AS sms_count
  FROM usage GROUP BY time_bucket(INTERVAL '5 minutes', event_time), region, event_type)"""

# The present moment of the reports: the latest event.
NOW = "(SELECT max(event_time) FROM usage)"
TODAY = "(SELECT CAST(max(event_time) AS DATE) FROM usage)"


def report(select: str, *tables: str) -> str:
    return "WITH " + ",".join([USAGE, *tables]) + "\n" + select


DAILY_COLUMNS = (
    "CAST(date AS VARCHAR) AS date, region, event_type, total_events, total_calls, total_sms,"
    " total_data_sessions, total_call_duration, avg_call_duration, max_call_duration,"
    " CAST(total_data_mb AS DOUBLE) AS total_data_mb, avg_data_mb,"
    " CAST(max_data_mb AS DOUBLE) AS max_data_mb, CAST(total_revenue AS DOUBLE) AS total_revenue,"
    " avg_transaction"
)

RULES = {
    "event_id_missing": "event_id IS NULL",
    "msisdn_missing": "msisdn IS NULL OR msisdn = ''",
    "event_type_unknown": "event_type IS NULL OR event_type NOT IN"
    " ('call', 'sms', 'data_session', 'balance_recharge', 'service_activation')",
    "timestamp_missing": "event_time IS NULL",
    "duration_negative": "duration_seconds < 0",
    "data_negative": "data_mb < 0",
    "amount_negative": "amount < 0",
    "data_out_of_range": "data_mb > 99999999.99",
    "amount_out_of_range": "amount > 99999999.99",
}
BROKEN = "concat_ws(',', " + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in RULES.items()) + ")"


def json_text(nulls: bool) -> str:
    """The event as JSON text, fields in order, numbers as they print."""
    quoted = ("event_id", "msisdn", "event_type", "event_subtype", "region")
    order = (
        "event_id", "msisdn", "event_type", "event_subtype", "duration_seconds", "data_mb",
        "amount", "region", "cell_tower_id", "timestamp",
    )

    def value(name: str) -> str:
        if name == "timestamp":
            return "'\"' || strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') || '\"'"
        return f"'\"' || {name} || '\"'" if name in quoted else f"CAST({name} AS VARCHAR)"

    fields = []
    for name in order:
        text = f"coalesce({value(name)}, 'null')" if nulls else value(name)
        fields.append(f"'\"{name}\":' || {text}")
    return "'{' || concat_ws(',', " + ", ".join(fields) + ") || '}'"


NO_JSON = "event_id_missing,msisdn_missing,event_type_unknown,timestamp_missing,field_unreadable"

# What the raw table takes of the events on the wire, each once.
ONCE = f"{WIRE},\nonce AS (SELECT DISTINCT * FROM wire WHERE {BROKEN} = '')"

# Events in windows that were closed for the query which read their half.
HALVES = f"""{USAGE},
halves AS (
  SELECT *, CAST(event_id AS BIGINT) % 2 AS half,
    max(event_time) OVER (PARTITION BY CAST(event_id AS BIGINT) % 2) - INTERVAL '1 minute' AS mark
  FROM usage),
counted AS (
  SELECT * FROM halves
  WHERE time_bucket(INTERVAL '5 minutes', event_time) + INTERVAL '5 minutes' <= mark)"""

TIME_TEXTS = f"""WITH {USAGE},
texts AS (
  SELECT event_id, CASE WHEN CAST(event_id AS BIGINT) % 11 = 0 THEN 'soon'
      WHEN CAST(event_id AS BIGINT) % 7 = 0 THEN strftime(event_time, '%Y-%m-%dT%H:%M:%SZ')
      ELSE strftime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') END AS text FROM usage)"""

ORACLE = {
    "metrics_5min": window_metrics(5, "event_type_5min", TYPE_KEYS, AVERAGES),
    "metrics_10min_region": window_metrics(10, "regional_10min", REGION_KEYS, NO_AVERAGES),
    "metrics_sliding": window_metrics(10, "event_type_10min_slide", TYPE_KEYS, AVERAGES, slide=5),
    "metrics_1hour_region": window_metrics(60, "regional_1hour", REGION_KEYS, NO_AVERAGES),
    "metrics_5min_conditional": report("SELECT * FROM conditional", CONDITIONAL),
    "cumulative_type_region": report(
        f"""SELECT {NOW} AS window_start, {NOW} AS window_end, 'batch_metrics' AS metric_type,
          region, event_type, CAST(NULL AS VARCHAR) AS event_subtype, {TOTALS}, {AVERAGES}
        FROM usage GROUP BY region, event_type"""
    ),
    "validate": f"WITH {WIRE} SELECT {EVENT_COLUMNS} FROM valid",
    "quarantine": f"WITH {WIRE} SELECT event_id, {BROKEN} AS broken_rules FROM wire WHERE {BROKEN} <> ''",
    "quarantine_counts": f"WITH {WIRE} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) AS n_rows FROM wire WHERE {condition}"
        for name, condition in RULES.items()
    ),
    "quarantine_payload": f"""WITH {WIRE},
sent AS (
  SELECT *, CAST(event_id AS BIGINT) AS k, {json_text(True)} AS text FROM wire),
arrived AS (
  SELECT * REPLACE (CASE WHEN k % 71 <> 0 AND k % 67 <> 0 AND k % 61 = 0 THEN NULL
      ELSE event_time END AS event_time),
    CASE WHEN k % 71 = 0 THEN substr(text, 1, 40)
      WHEN k % 67 = 0
        THEN replace(text, '"cell_tower_id":' || cell_tower_id, '"cell_tower_id":"north"')
      WHEN k % 61 = 0 THEN split_part(text, '"timestamp":', 1) || '"timestamp":"soon"}}'
      ELSE text END AS event_data,
    k % 71 = 0 OR k % 67 = 0 OR k % 61 = 0 AS misread
  FROM sent)
SELECT CASE WHEN k % 71 <> 0 THEN event_id END AS event_id, event_data,
  CASE WHEN k % 71 = 0 THEN '{NO_JSON}'
    ELSE concat_ws(',', nullif({BROKEN}, ''), CASE WHEN misread THEN 'field_unreadable' END)
    END AS broken_rules
FROM arrived WHERE misread OR {BROKEN} <> ''""",
    "strict_times": f"""{TIME_TEXTS}
SELECT event_id, try_strptime(text, '%Y-%m-%dT%H:%M:%S.%fZ') AS timestamp FROM texts""",
    "fallback_times": f"""{TIME_TEXTS}
SELECT event_id, coalesce(try_strptime(text, '%Y-%m-%dT%H:%M:%S.%fZ'),
  try_strptime(text, '%Y-%m-%dT%H:%M:%SZ'), TIMESTAMP '2030-01-01') AS timestamp FROM texts""",
    "dedup_events": f"WITH {WIRE} SELECT DISTINCT {EVENT_COLUMNS} FROM valid",
    "conform_raw_events": f"WITH {WIRE} SELECT {EVENT_COLUMNS} FROM valid",
    "decoded_json": f"WITH {WIRE} SELECT {EVENT_COLUMNS} FROM valid",
    "keyed_json": f"WITH {USAGE} SELECT msisdn AS key, {json_text(True)} AS value FROM usage",
    "subscriber_partitions": f"""WITH {USAGE}
        SELECT CAST(CAST('0x' || substr(md5(msisdn), 1, 8) AS BIGINT) % 8 AS INT) AS partition,
          count(*) AS n_events, count(DISTINCT msisdn) AS n_subscribers FROM usage GROUP BY 1""",
    "masked_users": """
        SELECT substr('7' || lpad(CAST(user_id * 7919 AS VARCHAR), 10, '0'), 1, 7) || '****' AS msisdn,
          count(*) AS n_events FROM events GROUP BY 1""",
    "anomalies": report("SELECT * FROM anomalies_found", ANOMALIES),
    "event_copy_json": report(
        f"""SELECT event_id, {json_text(False)} AS event_data FROM usage
        WHERE event_id IN (SELECT event_id FROM anomalies_found)""",
        ANOMALIES,
    ),
    "anomaly_high_frequency": report(
        """SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, msisdn, count_events
        FROM (SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start, msisdn,
                count(*) AS count_events FROM usage GROUP BY ALL)
        WHERE count_events > 1"""
    ),
    "anomaly_high_frequency_sliding": f"""WITH {USAGE},
shifted AS (
  SELECT msisdn, date_trunc('minute', event_time) - shift * INTERVAL '1 minute' AS start
  FROM (SELECT *, unnest(range(5)) AS shift FROM usage)),
busy AS (SELECT msisdn, start, count(*) AS n FROM shifted GROUP BY ALL HAVING count(*) > 1)
SELECT msisdn || '@' || strftime(start, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_id, msisdn,
  'high_frequency' AS anomaly_type, n || ' events in 5 minutes' AS anomaly_reason,
  'high' AS severity, start + INTERVAL '5 minutes' AS detected_at FROM busy""",
    "anomaly_rate": report(
        """SELECT round(count(*) * CAST(100 AS DOUBLE) / (SELECT count(*) FROM usage), 6)
          AS anomaly_rate_percent FROM anomalies_found""",
        ANOMALIES,
    ),
    "daily_stats": report(f"SELECT {DAILY_COLUMNS} FROM daily", DAILY),
    "hourly_stats": report(
        f"""SELECT hour_timestamp, region, event_type, total_events, total_duration, avg_duration,
          {double("total_data_mb")} AS total_data_mb, {double("total_amount")} AS total_amount
        FROM hourly""",
        HOURLY,
    ),
    "daily_stats_extended": report(
        f"""SELECT CAST(d.date AS VARCHAR) AS processing_date, d.region, d.event_type, total_events,
          {half_up("seconds", "3600", 2)} AS total_duration_hours,
          {half_up("mb_cents", "104857600", 6)} AS total_data_tb,
          total_recharge_amount,
          {half_up("call_seconds", "60 * n_calls", 2)} AS avg_call_duration_minutes,
          CASE WHEN event_type = 'data_session' THEN
            {half_up("mb_cents", "100 * unique_users", 2)} END AS avg_data_per_user_mb,
          unique_users,
          (SELECT hour FROM (
             SELECT CAST(date_part('hour', u.event_time) AS INT) AS hour, count(*) AS n FROM usage u
             WHERE CAST(u.event_time AS DATE) = d.date AND u.event_type = d.event_type
               AND u.region IS NOT DISTINCT FROM d.region
             GROUP BY 1) ORDER BY n DESC, hour LIMIT 1) AS peak_hour
        FROM (SELECT CAST(event_time AS DATE) AS date, region, event_type, count(*) AS total_events,
            coalesce(SUM(duration_seconds), 0) AS seconds, coalesce({cents("data_mb")}, 0) AS mb_cents,
            {double("coalesce(SUM(amount), 0)")} AS total_recharge_amount,
            SUM(duration_seconds) FILTER (WHERE event_type = 'call') AS call_seconds,
            count(duration_seconds) FILTER (WHERE event_type = 'call') AS n_calls,
            count(DISTINCT msisdn) AS unique_users
          FROM usage GROUP BY ALL) d"""
    ),
    "recent_counts": report(
        f"""SELECT count(*) AS events_last_5min, count(*) FILTER (WHERE event_type = 'call') AS calls,
          count(*) FILTER (WHERE event_type = 'sms') AS sms,
          count(*) FILTER (WHERE event_type = 'data_session') AS data_sessions
        FROM usage WHERE event_time >= {NOW} - INTERVAL '5 minutes'"""
    ),
    "recent_total": report(
        f"""SELECT count(*) AS events_last_5min FROM usage
        WHERE event_time >= {NOW} - INTERVAL '5 minutes'"""
    ),
    "region_users": report(
        f"""SELECT region, count(*) AS event_count, count(DISTINCT msisdn) AS unique_users
        FROM usage WHERE event_time >= {NOW} - INTERVAL '1 hour' GROUP BY region"""
    ),
    "anomaly_summary": report(
        f"""SELECT anomaly_type, count(*) AS anomaly_count,
          avg(CASE CAST(event_id AS BIGINT) % 4 WHEN 0 THEN 3 WHEN 1 THEN 2 ELSE 1 END) AS avg_severity
        FROM anomalies_found WHERE detected_at >= {NOW} - INTERVAL '30 days' GROUP BY anomaly_type""",
        ANOMALIES,
    ),
    "daily_summary_7d": report(
        f"""SELECT CAST(date AS VARCHAR) AS date, CAST(SUM(total_events) AS BIGINT) AS total_events,
          CAST(SUM(total_calls) AS BIGINT) AS total_calls, CAST(SUM(total_sms) AS BIGINT) AS total_sms,
          CAST(SUM(total_data_sessions) AS BIGINT) AS total_data_sessions,
          {half_up(cents("total_data_mb"), "102400", 2)} AS total_data_gb
        FROM daily WHERE date >= {TODAY} - INTERVAL '7 days' GROUP BY daily.date""",
        DAILY,
    ),
    "table_counts": report(
        """SELECT 'Raw Events' AS metric, count(*) AS value FROM usage
        UNION ALL SELECT 'Daily Stats', count(*) FROM daily
        UNION ALL SELECT 'Hourly Stats', count(*) FROM hourly
        UNION ALL SELECT 'Anomalies', count(*) FROM anomalies_found
        UNION ALL SELECT 'Real-time Metrics', count(*) FROM conditional""",
        DAILY, HOURLY, ANOMALIES, CONDITIONAL,
    ),
    "stream_table_counts": report(
        """SELECT 'Raw Events' AS table_name, count(*) AS count FROM usage
        UNION ALL SELECT 'Real-time Metrics', count(*) FROM conditional
        UNION ALL SELECT 'Anomalies', count(*) FROM anomalies_found""",
        ANOMALIES, CONDITIONAL,
    ),
    "peak_hours": report(
        f"""SELECT CAST(extract(hour FROM event_time) AS INT) AS hour, count(*) AS event_count,
          count(DISTINCT msisdn) AS unique_users
        FROM usage WHERE CAST(event_time AS DATE) = {TODAY} GROUP BY 1"""
    ),
    "top_regions_data": report(
        f"""SELECT region, count(*) AS sessions, {double("SUM(data_mb)")} AS total_data_mb,
          {half_up(cents("data_mb"), "100 * count(data_mb)", 2)} AS avg_data_mb
        FROM usage
        WHERE event_type = 'data_session' AND event_time >= {NOW} - INTERVAL '24 hours'
        GROUP BY region ORDER BY SUM(data_mb) DESC NULLS FIRST, region NULLS LAST LIMIT 10"""
    ),
    "call_durations": report(
        f"""SELECT {half_up("SUM(duration_seconds)", "60 * count(duration_seconds)", 2)} AS avg_call_minutes,
          {half_up("MAX(duration_seconds)", "60", 2)} AS max_call_minutes, count(*) AS total_calls
        FROM usage WHERE event_type = 'call' AND event_time >= {NOW} - INTERVAL '24 hours'"""
    ),
    "realtime_totals": report(
        f"""SELECT count(*) AS total, count(*) FILTER (WHERE event_type = 'call') AS calls,
          count(*) FILTER (WHERE event_type = 'sms') AS sms,
          count(*) FILTER (WHERE event_type = 'data_session') AS data_sessions,
          count(*) FILTER (WHERE event_time >= {NOW} - INTERVAL '5 minutes') AS last_5min
        FROM usage"""
    ),
    "anomaly_totals": report(
        f"""SELECT count(*) AS total_anomalies,
          count(*) FILTER (WHERE severity = 'high') AS high_severity,
          count(*) FILTER (WHERE detected_at >= {NOW} - INTERVAL '1 hour') AS last_hour
        FROM anomalies_found""",
        ANOMALIES,
    ),
    "top_regions": report(
        f"""SELECT region, count(*) AS events FROM usage
        WHERE event_time >= {NOW} - INTERVAL '1 hour'
        GROUP BY region ORDER BY count(*) DESC, region NULLS LAST LIMIT 5"""
    ),
    "health": report(
        """SELECT 'Raw Events' AS component, count(*) AS count,
          CASE WHEN count(*) > 1000 THEN '✅' ELSE '⚠️' END AS status FROM usage
        UNION ALL SELECT 'Daily Stats', count(*), CASE WHEN count(*) > 0 THEN '✅' ELSE '⚠️' END FROM daily
        UNION ALL SELECT 'Hourly Stats', count(*), CASE WHEN count(*) > 0 THEN '✅' ELSE '⚠️' END FROM hourly""",
        DAILY, HOURLY,
    ),
    "latest_metrics": report(
        """SELECT window_start, window_end, region, event_type, count_events, total_data_gb
        FROM conditional ORDER BY window_start DESC, region NULLS LAST, event_type NULLS LAST LIMIT 5""",
        CONDITIONAL,
    ),
    "top_daily": report(
        f"""SELECT CAST(date AS VARCHAR) AS date, region, event_type, total_events, total_call_duration,
          {double("total_data_mb")} AS total_data_mb
        FROM daily ORDER BY total_events DESC, daily.date, region NULLS LAST, event_type NULLS LAST LIMIT 5""",
        DAILY,
    ),
    "batch_summary": report(
        """SELECT raw_events, daily_stats, latest_daily_date, hourly_stats, latest_hourly
        FROM (SELECT count(*) AS raw_events FROM usage),
          (SELECT count(*) AS daily_stats, CAST(max(d.date) AS VARCHAR) AS latest_daily_date FROM daily d),
          (SELECT count(*) AS hourly_stats, max(h.hour_timestamp) AS latest_hourly FROM hourly h)""",
        DAILY, HOURLY,
    ),
    "event_mix": report(
        f"""SELECT event_type, count(*) AS event_count,
          {half_up("100 * count(*)", "(SELECT count(*) FROM usage)", 2)} AS share_percent,
          CASE event_type WHEN 'data_session' THEN 50 WHEN 'call' THEN 25 WHEN 'sms' THEN 15
            WHEN 'balance_recharge' THEN 7 WHEN 'service_activation' THEN 3 END AS expected_percent
        FROM usage GROUP BY event_type"""
    ),
    "hour_weight": report(
        """SELECT hour, count(*) AS event_count,
          CAST(CASE WHEN hour >= 8 AND hour <= 10 THEN 1.5 WHEN hour >= 12 AND hour <= 14 THEN 1.3
            WHEN hour >= 18 AND hour <= 22 THEN 2.0 WHEN hour <= 6 THEN 0.3 ELSE 1.0 END AS DOUBLE) AS weight
        FROM (SELECT CAST(extract(hour FROM event_time) AS INT) AS hour FROM usage) GROUP BY hour"""
    ),
    "quality_gate": report(
        f"""SELECT count(*) AS total_events,
          count(*) FILTER (WHERE event_time >= {TODAY} - INTERVAL '7 days'
            OR event_time + INTERVAL '2 days' >= {TODAY} - INTERVAL '7 days') AS recent_events,
          count(*) >= 100 AS passed
        FROM usage"""
    ),
    "verify_results": report(
        """SELECT 'daily_stats' AS table_name, count(*) AS n_rows, count(*) >= 1 AS passed FROM daily
        UNION ALL SELECT 'hourly_stats', count(*), TRUE FROM hourly""",
        DAILY, HOURLY,
    ),
    "retention_kept": report(
        f"""SELECT CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, count(*) AS n_events
        FROM usage WHERE event_time >= {TODAY} - INTERVAL '14 days' GROUP BY CAST(event_time AS DATE)"""
    ),
    "stream_metrics_5min": window_metrics(5, "event_type_5min", TYPE_KEYS, AVERAGES, closed(5)),
    "stream_metrics_10min": window_metrics(10, "regional_10min", REGION_KEYS, NO_AVERAGES, closed(10)),
    "stream_metrics_conditional": report(
        f"""SELECT * EXCLUDE (incoming_calls, outgoing_calls, sms_count),
          CAST(NULL AS DOUBLE) AS avg_duration_seconds FROM conditional
        WHERE window_end <= {NOW} - INTERVAL '1 minute'""",
        CONDITIONAL,
    ),
    "stream_high_frequency": report(
        f"""SELECT window_start, window_start + INTERVAL '5 minutes' AS window_end, msisdn, count_events
        FROM (SELECT time_bucket(INTERVAL '5 minutes', event_time) AS window_start, msisdn,
                count(*) AS count_events FROM usage GROUP BY ALL)
        WHERE count_events > 1 AND window_start + INTERVAL '6 minutes' <= {NOW}"""
    ),
    "stream_cumulative": report(
        f"""SELECT 'batch_metrics' AS metric_type, region, event_type,
          CAST(NULL AS VARCHAR) AS event_subtype, {TOTALS}, {AVERAGES}
        FROM usage GROUP BY region, event_type"""
    ),
    "stream_anomalies": report("SELECT * FROM anomalies_found", ANOMALIES),
    "stored_once": f"WITH {ONCE} SELECT {EVENT_COLUMNS} FROM once",
    "archive_windows": f"""SELECT * FROM (
      {window_metrics(5, "event_type_5min", TYPE_KEYS, AVERAGES, rows="once", tables=ONCE)})
    UNION ALL SELECT * FROM (
      {window_metrics(10, "regional_10min", REGION_KEYS, NO_AVERAGES, rows="once", tables=ONCE)})""",
    "stored_totals": f"""WITH {ONCE}
SELECT 'batch_metrics' AS metric_type, region, event_type, CAST(NULL AS VARCHAR) AS event_subtype,
  {TOTALS}, {AVERAGES} FROM once GROUP BY region, event_type""",
    "two_checkpoints": window_metrics(
        5, "event_type_5min", TYPE_KEYS, AVERAGES, rows="counted", tables=HALVES
    ),
    "early_alerts": report(
        """SELECT msisdn || '@' || strftime(start, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_id, msisdn,
          'high_frequency' AS anomaly_type, n || ' events in 5 minutes' AS anomaly_reason, 'high' AS severity
        FROM (SELECT time_bucket(INTERVAL '5 minutes', event_time) AS start, msisdn, count(*) AS n
              FROM usage GROUP BY ALL) WHERE n > 1"""
    ),
    "region_users_sketch": report(
        "SELECT region, count(*) AS event_count, TRUE AS close FROM usage GROUP BY region"
    ),
    "stream_dedup": f"WITH {WIRE} SELECT DISTINCT {EVENT_COLUMNS} FROM valid",
}
