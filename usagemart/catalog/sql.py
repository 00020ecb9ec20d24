"""The same questions in plain SQL over the same tables, for comparison by another engine.

Written from the definitions, not from the Spark code: shared inputs are common table expressions.
"""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
DAY_BEFORE = "TIMESTAMP '2024-01-30 00:00:00'"
TODAY = "DATE '2024-01-31'"


def _r2(x: str) -> str:
    return f"round_even(({x})::DECIMAL(18,6), 2)::DOUBLE"


def _exact(x: str, places: int, tie: str) -> str:
    """Whole-number rounding of a double's binary value, worked out in a subquery."""
    scale = 10 ** places
    q, rem = f"(m * {scale} // t)", f"(m * {scale} % t)"
    return f"""(SELECT CASE WHEN a < 0.004 THEN 0 WHEN k <= 0 THEN x
       ELSE sign(x) * ({q} + CASE WHEN 2 * {rem} > t OR (2 * {rem} = t AND {tie.format(q=q)}) THEN 1 ELSE 0 END)
            / {scale}.0::DOUBLE END
  FROM (SELECT x, a, k, (a * pow(2::DOUBLE, k))::BIGINT AS m, 1::BIGINT << greatest(k, 0) AS t
        FROM (SELECT x, abs(x) AS a, CASE WHEN abs(x) < 0.004 THEN 0
                     ELSE 53 - floor(log2(abs(x)))::INT END AS k
              FROM (SELECT ({x})::DOUBLE AS x))))"""


def _py(x: str, places: int = 2) -> str:
    return _exact(x, places, "{q} % 2 = 1")


def _page(x: str) -> str:
    return f"({_exact(x, 1, 'TRUE')})::DECIMAL(18,1)::VARCHAR"


def _avg(x: str) -> str:
    return f"sum({x})::DOUBLE / nullif(count({x}), 0)"


CUSTOMERS = """customers AS (
  SELECT c.c_custkey AS customer_id,
         CASE WHEN c.c_custkey % 50 = 7 THEN NULL ELSE split_part(c.c_name, '#', 1) END
           AS first_name,
         split_part(c.c_name, '#', 2) AS last_name,
         CASE WHEN c.c_custkey % 97 = 5 THEN NULL
              ELSE 'user' || c.c_custkey || '@example.com' END AS email,
         n.n_name AS company,
         CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'standard' WHEN 'BUILDING' THEN 'premium'
              WHEN 'FURNITURE' THEN 'enterprise' WHEN 'HOUSEHOLD' THEN 'inactive'
              WHEN 'MACHINERY' THEN 'partner' END AS segment,
         strftime(o.first_order, '%Y-%m-%d') AS registration_date,
         CASE WHEN c.c_acctbal < 0 THEN 'suspended' ELSE 'active' END AS status,
         o.spent::DOUBLE AS lifetime_value
  FROM customer c
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order,
                    sum(o_totalprice::DECIMAL(12,2)) AS spent
             FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey)"""


def _tel(name: str, first: str, last: str) -> str:
    return f"""{name} AS (
  SELECT user_id AS customer_id, ts::DATE AS date,
         ceil(sum(value::DECIMAL(10,2)))::BIGINT AS session_duration_minutes,
         count(*) FILTER (WHERE event_type = 'view') AS page_views,
         count(*) FILTER (WHERE event_type = 'click') AS clicks,
         count(*) FILTER (WHERE event_type = 'purchase') AS conversions
  FROM events
  WHERE ts >= TIMESTAMP '{first} 00:00:00' AND ts < TIMESTAMP '{last} 00:00:00' + INTERVAL 1 DAY
  GROUP BY 1, 2)"""


def _agg(name: str, tel: str) -> str:
    return f"""{name} AS (
  SELECT *, {_r2('coalesce(total_conversions / nullif(total_clicks, 0) * 100, 0)')}
              AS conversion_rate,
         {_r2('0.3 * total_session_minutes + 0.2 * total_page_views + 0.5 * total_clicks')}
              AS engagement_score
  FROM (SELECT customer_id, sum(session_duration_minutes)::BIGINT AS total_session_minutes,
               {_r2('avg(session_duration_minutes)')} AS avg_session_minutes,
               count(session_duration_minutes) AS active_days,
               sum(page_views)::BIGINT AS total_page_views, sum(clicks)::BIGINT AS total_clicks,
               sum(conversions)::BIGINT AS total_conversions
        FROM {tel} GROUP BY customer_id))"""


_METRICS = ["total_session_minutes", "avg_session_minutes", "active_days", "total_page_views",
            "total_clicks", "total_conversions", "conversion_rate", "engagement_score"]
_MASTER = ["customer_id", "first_name", "last_name", "email", "company", "segment",
           "registration_date", "status"]


def _staged(name: str, agg: str, load_date: str, created_at: str, where: str = "TRUE") -> str:
    metrics = ", ".join(f"coalesce(a.{m}, 0) AS {m}" for m in _METRICS)
    master = ", ".join(f"c.{m}" for m in _MASTER)
    return f"""{name} AS (
  SELECT {master}, coalesce(c.lifetime_value, 0) AS lifetime_value, {metrics},
         '{load_date}' AS load_date, '{created_at}' AS created_at
  FROM customers c LEFT JOIN {agg} a ON a.customer_id = c.customer_id WHERE {where})"""


_MONEY = ["lifetime_value", "total_session_minutes", "avg_session_minutes", "conversion_rate",
          "engagement_score"]
_COUNTERS = ["active_days", "total_page_views", "total_clicks", "total_conversions"]


def _typed(name: str, staged: str, updated_at: str) -> str:
    money = ", ".join(f"{m}::DECIMAL(18,2)::DOUBLE AS {m}" for m in _MONEY)
    counters = ", ".join(f"{m}::BIGINT AS {m}" for m in _COUNTERS)
    return f"""{name} AS (
  SELECT customer_id, first_name, last_name, email, company, segment,
         registration_date::DATE AS registration_date, status, {money}, {counters},
         load_date::DATE AS load_date, created_at::TIMESTAMP AS created_at,
         {updated_at} AS updated_at
  FROM {staged} LEFT JOIN seen USING (customer_id))"""


SEEN = "seen AS (SELECT user_id AS customer_id, max(ts) AS seen_at FROM events GROUP BY 1)"
NEVER = "NULL::TIMESTAMP"

_TWO_DAYS = [_tel("tel", "2024-01-29", "2024-01-30"), _agg("agg", "tel")]
_STAGED = [CUSTOMERS, *_TWO_DAYS, _staged("staged", "agg", "2024-01-30", "2024-01-31T00:00:00")]
_MART = [*_STAGED, SEEN, _typed("mart", "staged", "seen_at")]

_KNOWN = "(c.registration_date < '1996-01-01' OR c.status <> 'active')"
_YESTERDAY = [
    CUSTOMERS, SEEN, _tel("tel0", "2024-01-28", "2024-01-29"), _agg("agg0", "tel0"),
    _staged("staged0", "agg0", "2024-01-29", "2024-01-30T00:00:00", _KNOWN),
]
_TODAY = [
    *_TWO_DAYS,
    _staged("staged1", "agg", "2024-01-30", "2024-01-31T00:00:00", "c.status = 'active'"),
    _typed("staged_today", "staged1", NEVER),
]

_MERGED_COLUMNS = ["first_name", "last_name", "email", "company", "segment", "status",
                   "lifetime_value", *_METRICS, "load_date"]


def _upsert(current: str, new: str) -> str:
    taken = ", ".join(
        f"CASE WHEN n.customer_id IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}"
        for c in _MERGED_COLUMNS)
    kept = ", ".join(
        f"CASE WHEN o.customer_id IS NOT NULL THEN o.{c} ELSE n.{c} END AS {c}"
        for c in ["registration_date", "created_at"])
    return f"""SELECT coalesce(n.customer_id, o.customer_id) AS customer_id, {taken}, {kept},
       CASE WHEN n.customer_id IS NOT NULL THEN {AS_OF} ELSE o.updated_at END AS updated_at
FROM {current} o FULL JOIN {new} n ON n.customer_id = o.customer_id"""


# The segments, and below the texts of the reports.
DIM = """dim(segment_code, segment_name, description, min_engagement_score,
    max_engagement_score) AS (VALUES
  ('standard', 'Стандартный', 'Базовые клиенты с умеренной активностью', 0::DOUBLE, 50::DOUBLE),
  ('premium', 'Премиум', 'Активные клиенты с высоким вовлечением', 50, 80),
  ('enterprise', 'Корпоративный', 'Ключевые клиенты с максимальной активностью', 80, 100),
  ('inactive', 'Неактивный', 'Клиенты без активности в последний период', 0, 10))"""

_BAND = "m.engagement_score BETWEEN d.min_engagement_score AND d.max_engagement_score"

CLAIMS = """claims AS (
  SELECT CASE WHEN event_type IN ('view', 'click', 'purchase')
              THEN 'user' || user_id || '@example.com'
              WHEN event_type = 'signup' THEN 'guest' || user_id END AS email,
         CASE WHEN event_type = 'error' AND regexp_extract(props, '[0-9]+')::BIGINT >= 50
              THEN 'user' || user_id || '@example.com' END AS preferred_username,
         CASE event_type WHEN 'click' THEN user_id
              WHEN 'purchase' THEN regexp_extract(props, '[0-9]+')::BIGINT END
           AS requested_customer_id,
         'reports' AS aud, epoch_us(ts) // 1000000 AS iat, epoch_us(ts) // 1000000 + 300 AS exp
  FROM events)"""

DECISIONS = """decisions AS (
  SELECT q.caller AS email, q.requested_customer_id, m.customer_id,
         CASE WHEN q.caller IS NULL THEN 'invalid'
              WHEN m.customer_id IS NULL THEN 'no_profile'
              WHEN q.requested_customer_id <> m.customer_id THEN 'denied_other'
              ELSE 'allowed' END AS decision,
         q.has_email, q.has_username
  FROM (SELECT coalesce(email, preferred_username) AS caller, requested_customer_id,
               email IS NOT NULL AS has_email, preferred_username IS NOT NULL AS has_username
        FROM claims) q
  LEFT JOIN mart m ON m.email = q.caller)"""

_DECISIONS = [*_MART, CLAIMS, DECISIONS]
_ALLOWED = "(SELECT customer_id FROM decisions WHERE decision = 'allowed')"

_H = "(m.total_session_minutes / 60)"
REPORT = f"""report AS (
  SELECT customer_id, concat(first_name, ' ', last_name) AS name, email, segment,
         registration_date, status, {_py(_H)} AS total_hours,
         {_py(f'CASE WHEN active_days > 0 THEN {_H} / active_days ELSE 0 END')}
           AS avg_daily_hours,
         active_days, total_page_views, total_clicks, total_conversions,
         {_py('conversion_rate')} AS conversion_rate, {_py('engagement_score')}
           AS engagement_score,
         {_py(f'CASE WHEN {_H} > 0 THEN total_clicks / {_H} ELSE 0 END')} AS actions_per_hour,
         {_py('lifetime_value')} AS lifetime_value,
         {_py(f'CASE WHEN {_H} > 0 THEN lifetime_value / {_H} ELSE 0 END')} AS value_per_hour,
         load_date, updated_at, created_at,
         CASE WHEN updated_at > {AS_OF} - INTERVAL 1 DAY THEN 'fresh' ELSE 'stale' END
           AS data_freshness
  FROM mart m)"""
_REPORT = [*_MART, REPORT]

_REPORT_BODY = """name, email, segment, registration_date, status, total_hours, avg_daily_hours,
       active_days, total_page_views, total_clicks, total_conversions, conversion_rate,
       engagement_score, actions_per_hour, lifetime_value, value_per_hour, load_date, updated_at,
       created_at, data_freshness"""

_CHECKS = """checks AS (
  SELECT count(*) AS total_records, count(*) FILTER (WHERE email IS NULL) AS null_emails,
         count(*) FILTER (WHERE total_session_minutes < 0 OR engagement_score < 0)
           AS negative_values,
         max(load_date) AS max_load_date, min(load_date) AS min_load_date,
         count(*) FILTER (WHERE total_conversions > 0 AND total_clicks = 0) AS undefined_rate
  FROM mart)"""

_ISSUES = """issues AS (
  SELECT concat_ws('; ',
           CASE WHEN null_emails > 0 THEN 'Found ' || null_emails || ' records with null emails'
           END,
           CASE WHEN negative_values > 0
                THEN 'Found ' || negative_values || ' records with negative values' END) AS issues,
         (null_emails > 0)::INT::BIGINT + (negative_values > 0)::INT::BIGINT AS issue_count,
         total_records
  FROM checks)"""

_LOAD_STATS = f"""stats AS (
  SELECT segment, count(*) AS n, {_avg('engagement_score::DECIMAL(18,2)')} AS avg_engagement
  FROM mart GROUP BY segment)"""


def _iso(ts: str) -> str:
    return (f"CASE WHEN date_trunc('second', {ts}) = {ts} "
            f"THEN strftime({ts}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') END")


def _violations() -> str:
    """Per declared column: values that are too long or do not fit the declared type."""
    lengths = {"first_name": 100, "last_name": 100, "email": 255, "company": 200, "segment": 50,
               "status": 20}
    types = {"customer_id": "INTEGER", "registration_date": "DATE",
             "lifetime_value": "DECIMAL(12,2)", "total_session_minutes": "DECIMAL(10,2)",
             "avg_session_minutes": "DECIMAL(10,2)", "active_days": "INTEGER",
             "total_page_views": "INTEGER", "total_clicks": "INTEGER",
             "total_conversions": "INTEGER", "conversion_rate": "DECIMAL(5,2)",
             "engagement_score": "DECIMAL(10,2)", "load_date": "DATE", "created_at": "TIMESTAMP"}
    tests = {c: f"length({c}) > {n}" for c, n in lengths.items()}
    tests |= {c: f"{c} IS NOT NULL AND try_cast({c} AS {t}) IS NULL" for c, t in types.items()}
    return "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {t}) AS violations FROM staged"
        for c, t in tests.items())


def _with(parts: list[str], body: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n" + body


_STAGED_MONTH = [
    CUSTOMERS, SEEN, _tel("tel30", "2024-01-01", "2024-01-30"), _agg("agg30", "tel30"),
    _staged("staged30", "agg30", "2024-01-30", "2024-01-31T00:00:00"),
]

_REFRESH = [
    *_DECISIONS, _tel("tel0", "2024-01-28", "2024-01-29"), _agg("agg0", "tel0"),
    _staged("staged0", "agg0", "2024-01-29", "2024-01-30T00:00:00"),
    _typed("before", "staged0", "seen_at"),
    _staged("staged1", "agg", "2024-01-31", "2024-01-31T00:00:00", f"c.customer_id IN {_ALLOWED}"),
    _typed("recomputed", "staged1", NEVER),
]
_NIGHTS = [*_YESTERDAY, _typed("before", "staged0", DAY_BEFORE), *_TODAY]
_MERGED = f"merged AS ({_upsert('before', 'staged_today')})"
_STREAM = [
    *_STAGED_MONTH,
    """streamed AS (SELECT DISTINCT user_id FROM events
  WHERE ts >= TIMESTAMP '2023-12-02 00:00:00' AND ts < TIMESTAMP '2024-01-31 00:00:00')""",
    _typed("mart", "staged30",
           f"CASE WHEN customer_id IN (SELECT user_id FROM streamed) THEN {AS_OF} END"),
]


def _performance(mart: str) -> str:
    return f"""
SELECT segment, count(*) AS customer_count,
       {_avg('lifetime_value::DECIMAL(18,2)')} AS avg_lifetime_value,
       {_avg('engagement_score::DECIMAL(18,2)')} AS avg_engagement,
       sum(total_conversions)::BIGINT AS total_conversions,
       {_avg('conversion_rate::DECIMAL(18,2)')} AS avg_conversion_rate,
       max(load_date) AS last_update_date
FROM {mart} GROUP BY segment"""


_REPORT_LINES = f"""
SELECT '2024-01-30' AS execution_date, 'SUCCESS' AS status, i.total_records,
       coalesce(s.segment, 'None') AS segment,
       coalesce(s.segment, 'None') || ': ' || s.n || ' records (avg engagement: '
         || ({_py('s.avg_engagement')})::DECIMAL(18,2) || ')' AS line,
       i.issue_count AS issues_found,
       CASE WHEN i.issue_count = 0 THEN 'PASS' ELSE 'WARNINGS' END AS quality
FROM stats s, issues i"""

SQL: dict[str, str] = {
    "src_customers": _with([CUSTOMERS], "SELECT * FROM customers"),
    "src_telemetry": _with(_TWO_DAYS[:1], "SELECT * FROM tel"),
    "extract_counts": _with([CUSTOMERS, *_TWO_DAYS], """
SELECT c.n AS customers, t.n AS telemetry, c.n + t.n AS records_count,
       '2024-01-31T00:00:00' AS extracted_at
FROM (SELECT count(*) AS n FROM customers) c, (SELECT count(*) AS n FROM tel) t"""),
    "segment_dim": _with([CUSTOMERS, DIM], """
SELECT u.segment, d.* FROM (SELECT DISTINCT segment FROM customers) u
LEFT JOIN dim d ON d.segment_code = u.segment"""),
    "mart_scan": _with(_MART, "SELECT * FROM mart"),
    "csv_round_trip": _with(_STAGED, "SELECT * FROM staged"),
    "telemetry_agg": _with(_TWO_DAYS, "SELECT * FROM agg"),
    "telemetry_agg_30d": _with(
        [_tel("tel", "2024-01-01", "2024-01-30"), _agg("agg", "tel")], "SELECT * FROM agg"),
    "customer_mart": _with(_STAGED, "SELECT * FROM staged"),
    "mart_typed": _with([*_STAGED, SEEN, _typed("mart", "staged", NEVER)], "SELECT * FROM mart"),
    "mart_metadata": _with(_STAGED, f"""
SELECT (SELECT count(*) FROM staged) AS row_count,
       '{','.join([*_MASTER, 'lifetime_value', *_METRICS, 'load_date', 'created_at'])}' AS columns,
       segment, count(*) AS n
FROM staged WHERE segment IS NOT NULL GROUP BY segment"""),
    "mart_sample": _with(_MART, "SELECT * FROM mart ORDER BY customer_id LIMIT 3"),
    "mart_upsert": _with([*_YESTERDAY, _typed("before", "staged0", "seen_at"), *_TODAY],
                         _upsert("before", "staged_today")),
    "insert_ignore": _with([*_YESTERDAY, _typed("before", "staged0", "seen_at"), *_TODAY], """
SELECT * FROM before UNION ALL BY NAME
SELECT * FROM staged_today WHERE customer_id NOT IN (SELECT customer_id FROM before)"""),
    "manual_refresh": _with(_DECISIONS, f"""
SELECT customer_id, email, {TODAY} AS load_date, {AS_OF} AS updated_at
FROM mart WHERE customer_id IN {_ALLOWED}"""),
    "refresh_run": _with(_REFRESH, _upsert("before", "recomputed")),
    "refresh_run_performance": _with(
        [*_REFRESH, f"merged AS ({_upsert('before', 'recomputed')})"], _performance("merged")),
    "audit_log": _with(_DECISIONS, f"""
SELECT 'nightly_load' AS process_name, DATE '2024-01-30' AS execution_date,
       {DAY_BEFORE} AS start_time, {AS_OF} AS end_time, count(*) AS records_processed,
       'success' AS status, NULL::VARCHAR AS error_message, {AS_OF} AS created_at
FROM mart
UNION ALL
SELECT 'manual_report_generation', DATE '2024-01-30', {DAY_BEFORE}, {AS_OF}, count(*), 'success',
       NULL, {AS_OF}
FROM mart WHERE customer_id IN {_ALLOWED}"""),
    "customer_analytics": _with([*_MART, DIM], f"""
SELECT m.customer_id, concat(m.first_name, ' ', m.last_name) AS full_name, m.email, m.company,
       m.segment, d.segment_name, m.registration_date,
       extract(year FROM age({TODAY}, m.registration_date))::INT AS years_as_customer,
       m.status, m.lifetime_value, m.total_session_minutes, m.avg_session_minutes, m.active_days,
       m.total_page_views, m.total_clicks, m.total_conversions, m.conversion_rate,
       m.engagement_score,
       CASE WHEN {_BAND} THEN 'В рамках сегмента' ELSE 'Требует пересмотра сегмента' END
         AS segment_validation,
       m.load_date, m.updated_at
FROM mart m LEFT JOIN dim d ON d.segment_code = m.segment"""),
    "segment_review": _with([*_MART, DIM], f"""
SELECT m.customer_id, m.segment, m.engagement_score, d.min_engagement_score,
       d.max_engagement_score
FROM mart m LEFT JOIN dim d ON d.segment_code = m.segment
WHERE NOT coalesce({_BAND}, FALSE)"""),
    "segment_performance": _with(_MART, _performance("mart")),
    "segment_value_counts": _with(_MART, """
SELECT segment, count(*) AS n FROM mart WHERE segment IS NOT NULL GROUP BY segment"""),
    "segment_load_stats": _with([*_MART, _LOAD_STATS], "SELECT * FROM stats"),
    "segment_map": _with([*_MART, _LOAD_STATS], """
SELECT (SELECT count(*) FROM mart) AS total_records, '2024-01-31T00:00:00' AS loaded_at, segment, n,
       avg_engagement FROM stats"""),
    "segment_counts": _with(_MART, "SELECT segment, count(*) AS n FROM mart GROUP BY segment"),
    "top_segment": _with(_MART, """
SELECT segment, count(*) AS n FROM mart GROUP BY segment ORDER BY n DESC, segment LIMIT 1"""),
    "top_engaged": _with(_MART, """
SELECT customer_id, engagement_score FROM mart
ORDER BY engagement_score DESC, customer_id LIMIT 10"""),
    "caller_info": _with([CLAIMS], """
SELECT coalesce(email, preferred_username) AS user_email, email IS NOT NULL AS has_email,
       preferred_username IS NOT NULL AS has_username, aud AS audience, iat AS issued_at,
       exp AS expires_at
FROM claims WHERE email IS NOT NULL OR preferred_username IS NOT NULL"""),
    "access_decisions": _with(_DECISIONS, "SELECT * FROM decisions"),
    "access_filter": _with(_DECISIONS, f"SELECT * FROM mart WHERE customer_id IN {_ALLOWED}"),
    "customer_report": _with(_REPORT, "SELECT * FROM report"),
    "reports_ordered": _with(_REPORT, """
SELECT * FROM report ORDER BY updated_at DESC NULLS FIRST, customer_id"""),
    "customer_report_nested": _with(_REPORT, f"""
SELECT customer_id AS id, {_REPORT_BODY} FROM report"""),
    "report_envelope": _with([*_DECISIONS, REPORT], f"""
SELECT a.caller, 'self_only' AS access_level, 1::BIGINT AS n,
       'Access restricted to your own data only' AS message, r.customer_id AS id, {_REPORT_BODY}
FROM (SELECT DISTINCT email AS caller, customer_id FROM decisions WHERE decision = 'allowed') a
JOIN report r ON r.customer_id = a.customer_id"""),
    "report_json": _with(_REPORT, f"""
SELECT customer_id, customer_id AS id, name, email,
       strftime(registration_date, '%Y-%m-%d') AS registration_date, total_hours, value_per_hour,
       {_iso('updated_at')} AS updated_at, {_iso('created_at')} AS created_at FROM report"""),
    "report_display": _with(_REPORT, f"""
SELECT name, email, segment, {_page('total_hours')} AS hours_used,
       {_page('engagement_score')} AS engagement,
       '$' || lifetime_value::DECIMAL(18,2)::VARCHAR AS lifetime_value,
       coalesce(strftime(updated_at, '%-m/%-d/%Y, %-I:%M:%S %p'), 'Never') AS last_updated,
       data_freshness AS freshness
FROM report"""),
    "report_json_dates": _with(_REPORT, f"""
SELECT customer_id, strftime(registration_date, '%Y-%m-%d') AS registration_date,
       strftime(load_date, '%Y-%m-%d') AS load_date, {_iso('updated_at')} AS updated_at,
       {_iso('created_at')} AS created_at
FROM report"""),
    "customer_summary": _with(_MART, f"""
SELECT customer_id, total_records, {_py('engagement')} AS avg_engagement, total_conversions,
       {_py('value')} AS avg_lifetime_value, {_py('minutes / 60', 1)} AS total_usage_hours,
       last_update, first_load, reporting_period_days, generate_new, message
FROM (SELECT customer_id, count(*) AS total_records, avg(engagement_score) AS engagement,
       sum(total_conversions)::BIGINT AS total_conversions,
       avg(lifetime_value) AS value, sum(total_session_minutes) AS minutes,
       max(updated_at) AS last_update, min(load_date) AS first_load,
       date_diff('day', min(load_date), {TODAY})::INT AS reporting_period_days,
       coalesce(max(updated_at) <= {AS_OF} - INTERVAL 2 DAY, FALSE) AS generate_new,
       CASE WHEN max(updated_at) > {AS_OF} - INTERVAL 2 DAY THEN 'Data is up to date'
            ELSE 'Consider generating new report' END AS message
FROM mart GROUP BY customer_id)"""),
    "freshness_status": _with(_MART, f"""
SELECT s.*, CASE freshness WHEN 'fresh' THEN 'green' WHEN 'recent' THEN 'blue'
              WHEN 'daily' THEN 'yellow' ELSE 'red' END AS freshness_color,
       recommendation = 'needs_update' AS is_action_required,
       recommendation = 'needs_update' AS show_warning,
       'Data is ' || freshness || '. Consider generating a new report.' AS warning_message
FROM (SELECT customer_id, updated_at, load_date, count(*) AS record_count,
             CASE WHEN updated_at > {AS_OF} - INTERVAL 5 MINUTE THEN 'fresh'
                  WHEN updated_at > {AS_OF} - INTERVAL 1 HOUR THEN 'recent'
                  WHEN updated_at > {AS_OF} - INTERVAL 24 HOUR THEN 'daily'
                  ELSE 'stale' END AS freshness,
             CASE WHEN updated_at > {AS_OF} - INTERVAL 1 HOUR THEN 'up_to_date'
                  ELSE 'needs_update' END AS recommendation
      FROM mart GROUP BY customer_id, updated_at, load_date) s"""),
    "user_segments": _with(_MART, """
SELECT DISTINCT email, segment FROM mart WHERE email IS NOT NULL AND segment IS NOT NULL"""),
    "user_segment_list": _with(_MART, """
SELECT email, string_agg(DISTINCT segment, ',' ORDER BY segment) AS segments,
       count(DISTINCT segment) AS n
FROM mart WHERE email IS NOT NULL AND segment IS NOT NULL GROUP BY email"""),
    "dq_checks": _with([*_MART, _CHECKS], "SELECT * FROM checks"),
    "dq_issues": _with([*_MART, _CHECKS, _ISSUES], """
SELECT issues, issue_count, issue_count = 0 AS is_valid, total_records FROM issues"""),
    "dq_duplicate_keys": _with([*_YESTERDAY, *_TODAY], """
SELECT customer_id, count(*) AS n
FROM (SELECT customer_id FROM staged0 UNION ALL SELECT customer_id FROM staged1)
GROUP BY customer_id HAVING count(*) > 1"""),
    "dq_type_violations": _with(_STAGED, _violations()),
    "run_report": _with([*_MART, _LOAD_STATS, _CHECKS, _ISSUES], _REPORT_LINES),
    "nightly_run": _with(_NIGHTS, _upsert("before", "staged_today")),
    "nightly_run_performance": _with([*_NIGHTS, _MERGED], _performance("merged")),
    "nightly_run_report": _with(
        [*_NIGHTS, _MERGED, *(part.replace("FROM mart", "FROM merged") for part in (_LOAD_STATS, _CHECKS)),
         _ISSUES], _REPORT_LINES),
    "stream_telemetry_agg": _with(_STREAM, "SELECT * EXCLUDE (load_date) FROM mart"),
    "stream_performance": _with(_STREAM, _performance("mart")),
}
