"""The queries as SQL over the test tables, to compare results with."""

from __future__ import annotations

ACCESS_LOG = """
ev AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events
),
e AS (
  SELECT ev.*, dup FROM ev
  JOIN (VALUES (0), (1)) AS copies(dup) ON dup = 0 OR event_id % 50 = 0
),
access_log AS (
  SELECT
    '10.0.' || CAST(CAST(floor(user_id / 256) AS BIGINT) AS VARCHAR) || '.'
      || CAST(user_id % 256 AS VARCHAR) AS remote_addr,
    CAST(date_trunc('second', ts) AS TIMESTAMP) AS "timestamp",
    CASE event_type WHEN 'purchase' THEN 'POST' WHEN 'signup' THEN 'PUT' ELSE 'GET' END
      AS method,
    CASE WHEN event_id % 97 <> 0 THEN '/' || event_type || '/' || CAST(k % 20 AS VARCHAR) END
      AS url,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'HTTP/2.0'
      ELSE 'HTTP/1.1' END AS protocol,
    CAST(CASE
      WHEN event_id % 101 = 0 THEN NULL
      WHEN event_type = 'error' THEN
        CASE k % 4 WHEN 0 THEN 404 WHEN 1 THEN 500 WHEN 2 THEN 403 ELSE 499 END
      WHEN event_id % 11 = 0 THEN 302
      ELSE 200 END AS INT) AS status,
    CAST(floor(value * 1000) AS BIGINT) + dup AS body_bytes_sent,
    CASE WHEN event_id % 5 = 0 THEN '-'
      ELSE 'https://example.org/' || CAST(user_id AS VARCHAR) END AS http_referer,
    'Mozilla/5.0 (X11; id ' || CAST(user_id % 7 + dup AS VARCHAR) || ')' AS user_agent
  FROM e
)"""

LOOKUP = """
lookup AS (
  SELECT
    '10.0.' || CAST(CAST(floor(c_custkey / 256) AS BIGINT) AS VARCHAR) || '.'
      || CAST(c_custkey % 256 AS VARCHAR) AS client_ip,
    CASE WHEN c_custkey % 3 <> 0
      THEN lower(replace(c_name, '#', '-')) || '.example.net' END AS hostname
  FROM customer
),
names AS (
  SELECT client_ip, min(hostname) AS client_hostname FROM lookup GROUP BY client_ip
)"""

REQUEST_COLUMNS = """remote_addr, "timestamp", method, url, protocol, status,
  body_bytes_sent, http_referer, user_agent"""

DESCRIBED = """
  CAST(year("timestamp") AS INT) AS "year", CAST(month("timestamp") AS INT) AS "month",
  CAST(day("timestamp") AS INT) AS "day", CAST(hour("timestamp") AS INT) AS "hour",
  status >= 400 AS is_error, CAST(status // 100 AS VARCHAR) || 'xx' AS status_class"""


def _silver(source: str) -> str:
    """CTEs that refine the CTE ``source`` to ``silver``."""
    return f"""
enriched AS (
  SELECT {REQUEST_COLUMNS}, client_hostname
  FROM {source} LEFT JOIN names ON remote_addr = client_ip
),
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY remote_addr, "timestamp", method, url
    ORDER BY status NULLS LAST, body_bytes_sent NULLS LAST, protocol NULLS LAST,
      http_referer NULLS LAST, user_agent NULLS LAST, client_hostname NULLS LAST
  ) AS rn FROM enriched
),
silver AS (
  SELECT {REQUEST_COLUMNS}, {DESCRIBED}, client_hostname FROM ranked WHERE rn = 1
)"""


# Keys, columns and types of the star as its tables are specified.
STAR = """
stg AS (
  SELECT
    md5(CAST(remote_addr AS VARCHAR) || CAST("timestamp" AS VARCHAR) || method || url)
      AS request_id,
    remote_addr, client_hostname, "timestamp" AS request_timestamp,
    CAST("timestamp" AS DATE) AS request_date, method, url, protocol, status, status_class,
    is_error, body_bytes_sent, http_referer, user_agent
  FROM silver
),
dim_ip AS (
  SELECT DISTINCT md5(remote_addr) AS ip_sk, remote_addr AS ip_address, client_hostname FROM stg
),
dim_status AS (
  SELECT DISTINCT md5(CAST(status AS VARCHAR)) AS status_sk, status AS status_code,
    status_class, is_error
  FROM stg
),
dim_request AS (
  SELECT DISTINCT md5(method || url || protocol) AS request_sk, method, url, protocol FROM stg
),
dim_date AS (
  SELECT DISTINCT md5(CAST(request_date AS VARCHAR)) AS date_sk, request_date AS full_date,
    extract(year FROM request_date) AS "year", extract(month FROM request_date) AS "month",
    extract(day FROM request_date) AS "day", dayname(request_date) AS day_name,
    extract(dayofweek FROM request_date) IN (0, 6) AS is_weekend
  FROM stg
),
fact_requests AS (
  SELECT request_id, md5(remote_addr) AS ip_sk, md5(CAST(request_date AS VARCHAR)) AS date_sk,
    md5(CAST(status AS VARCHAR)) AS status_sk, md5(method || url || protocol) AS request_sk,
    request_timestamp, body_bytes_sent, http_referer, user_agent
  FROM stg
)"""

# The summaries are stated straight over silver, so that keys and joins of the Spark side
# are checked against something without them.
_WITH_STATUS = "FROM silver WHERE status IS NOT NULL"
# Method, URL and protocol are known together or not at all.
_WITH_REQUEST = "FROM silver WHERE url IS NOT NULL"

SUMMARIES = {
    "kpi_summary": f"""
SELECT count(*) AS total_requests, count(DISTINCT remote_addr) AS unique_ips,
  round(count_if(status >= 400) * 100.0 / count(*), 2) AS error_rate_pct,
  round(sum(body_bytes_sent) / count(body_bytes_sent) / 1024.0, 2) AS avg_kb_per_req
{_WITH_STATUS}""",
    "agg_hourly_traffic": f"""
SELECT time_bucket(INTERVAL 1 HOUR, "timestamp") AS "hour", count(*) AS total_requests,
  count(*) FILTER (WHERE status BETWEEN 200 AND 299) AS success_2xx,
  count(*) FILTER (WHERE status >= 400) AS errors_4xx5xx
{_WITH_STATUS} GROUP BY ALL""",
    "agg_status_breakdown": f"""
SELECT format('{{}}xx', status // 100) AS status_class, count(*) AS request_count
{_WITH_STATUS} GROUP BY ALL""",
    "agg_top_endpoints": f"""
SELECT url, method, count(*) AS request_count
{_WITH_REQUEST} GROUP BY ALL ORDER BY request_count DESC, url, method LIMIT 8""",
    "agg_method_split": f"""
SELECT method, count(*) AS request_count,
  round(count(*) * 100.0 / (SELECT count(*) {_WITH_REQUEST}), 2) AS pct
{_WITH_REQUEST} GROUP BY method""",
    "agg_error_detail": """
SELECT status AS status_code, any_value(status_class) AS status_class,
  count(*) AS error_count,
  round(count(*) * 100.0 / (SELECT count(*) FROM silver WHERE status >= 400), 2) AS pct
FROM silver WHERE status >= 400
GROUP BY status ORDER BY error_count DESC, status LIMIT 10""",
    "agg_day_of_week": """
SELECT strftime("timestamp", '%A') AS day_name,
  CAST(isodow("timestamp") % 7 AS INT) AS day_order, isodow("timestamp") >= 6 AS is_weekend,
  count(*) AS total_requests, round(count(*) / 24.0, 2) AS avg_req_per_hour
FROM silver GROUP BY ALL""",
    "agg_daily_bytes": """
SELECT "timestamp"::DATE AS full_date, isodow("timestamp") >= 6 AS is_weekend,
  if(isodow("timestamp") >= 6, 'Weekend', 'Weekday') AS day_type,
  sum(body_bytes_sent) / 1073741824.0 AS total_gb, count(*) AS request_count,
  sum(body_bytes_sent) / count(body_bytes_sent) / 1024.0 AS avg_kb_per_req
FROM silver GROUP BY ALL""",
}

STAR_TABLES = ("dim_ip", "dim_status", "dim_request", "dim_date", "fact_requests")

_LOG = f"WITH {ACCESS_LOG}"
_SILVER = f"WITH {ACCESS_LOG}, {LOOKUP}, {_silver('access_log')}"
_STAR = f"{_SILVER}, {STAR}"


def _unique(table: str, column: str) -> str:
    return f"""
SELECT 'unique' AS "check", '{table}' AS "table", '{column}' AS "column",
  count(*) AS failures, count(*) = 0 AS passed
FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL
  GROUP BY {column} HAVING count(*) > 1)"""


def _not_null(table: str, column: str, check: str = "not_null") -> str:
    return f"""
SELECT '{check}' AS "check", '{table}' AS "table", '{column}' AS "column",
  count(*) AS failures, count(*) = 0 AS passed
FROM {table} WHERE "{column}" IS NULL"""


def _related(column: str, parent: str) -> str:
    return f"""
SELECT 'relationships' AS "check", 'fact_requests' AS "table", '{column}' AS "column",
  count(*) AS failures, count(*) = 0 AS passed
FROM fact_requests WHERE {column} IS NOT NULL
  AND {column} NOT IN (SELECT {column} FROM {parent} WHERE {column} IS NOT NULL)"""


def _rows(stage: str, query: str) -> str:
    return f"SELECT '{stage}' AS stage, count(*) AS \"rows\" FROM ({query})"


def _registered(table: str, status: str, query: str) -> str:
    return (f"SELECT '{table}' AS \"table\", '{status}' AS status, "
            f"count(*) AS row_count FROM ({query})")


_UNIQUE = (("dim_ip", "ip_sk"), ("dim_status", "status_sk"), ("dim_date", "date_sk"),
           ("dim_request", "request_sk"), ("fact_requests", "request_id"))
_NOT_NULL = _UNIQUE + tuple(
    ("fact_requests", c) for c in ("ip_sk", "status_sk", "date_sk", "request_sk"))
_SOURCE = tuple(("silver", c) for c in ("remote_addr", "timestamp", "status"))
_RELATED = (("ip_sk", "dim_ip"), ("status_sk", "dim_status"), ("date_sk", "dim_date"),
            ("request_sk", "dim_request"))

_CUT = "TIMESTAMP '2024-01-16 00:00:00'"
_UNTIMED = f"""
untimed AS (
  SELECT remote_addr,
    CASE WHEN body_bytes_sent % 89 <> 0 THEN "timestamp" END AS "timestamp",
    method, url, protocol, status, body_bytes_sent, http_referer, user_agent
  FROM access_log
)"""

_MODELS = [(t, f"SELECT * FROM {t}") for t in STAR_TABLES] + list(SUMMARIES.items())

# The reading order of each summary.
_ORDERS = (
    ("agg_hourly_traffic", "hour", "ASC"), ("agg_status_breakdown", "request_count", "DESC"),
    ("agg_top_endpoints", "request_count", "DESC"), ("agg_method_split", "request_count", "DESC"),
    ("agg_error_detail", "error_count", "DESC"), ("agg_day_of_week", "day_order", "ASC"),
    ("agg_daily_bytes", "full_date", "ASC"),
)


def _placed(summary: str, column: str, direction: str) -> str:
    return f"""
SELECT '{summary}' AS summary, row_number() OVER (ORDER BY "{column}" {direction}) AS position,
  CAST("{column}" AS VARCHAR) AS value
FROM ({SUMMARIES[summary]})"""


ORACLE_SQL: dict[str, str] = {
    "parse_access_log": f"{_LOG} SELECT {REQUEST_COLUMNS} FROM access_log",
    "parse_log_lines": f"{_LOG} SELECT {REQUEST_COLUMNS} FROM access_log",
    "type_requests": f"{_LOG} SELECT {REQUEST_COLUMNS}, {DESCRIBED} FROM access_log",
    "status_class_flags": f"""{_LOG}, described AS (SELECT status, {DESCRIBED} FROM access_log)
SELECT status, status_class, is_error, count(*) AS request_count
FROM described GROUP BY 1, 2, 3""",
    "enrich_hostnames": f"{_SILVER} SELECT * FROM enriched",
    "enrich_hostnames_shuffled": f"{_SILVER} SELECT * FROM enriched",
    "dedup_requests": f"{_SILVER} SELECT {REQUEST_COLUMNS} FROM silver",
    "silver_requests": f"{_SILVER} SELECT * FROM silver",
    "silver_roundtrip":
        f"WITH {ACCESS_LOG}, {LOOKUP}, {_UNTIMED}, {_silver('untimed')} SELECT * FROM silver",
    "silver_unpartitioned": f"""WITH {ACCESS_LOG}, {LOOKUP}, {_UNTIMED}, {_silver('untimed')}
SELECT * EXCLUDE ("year", "month", "day") FROM silver""",
    "ingest_metrics": _SILVER + " " + " UNION ALL ".join((
        _rows("raw_lines", "SELECT * FROM access_log"),
        _rows("with_address", "SELECT * FROM access_log WHERE remote_addr IS NOT NULL"),
        _rows("newer", "SELECT * FROM access_log"),
        _rows("written", "SELECT * FROM silver"),
        _rows("silver_total", "SELECT * FROM silver"),
    )),
    # A line has the first reason that applies. Lines with no URL have one word for a request.
    "bad_line_counts": f"""WITH {ACCESS_LOG}, {_UNTIMED}, lines AS (
  SELECT CASE
      WHEN body_bytes_sent % 41 = 0 THEN 'short_line'
      WHEN body_bytes_sent % 43 = 0 THEN 'surplus_fields'
      WHEN body_bytes_sent % 47 = 0 THEN 'no_address'
      WHEN "timestamp" IS NULL THEN 'time'
      WHEN url IS NULL THEN 'request'
      WHEN status IS NULL THEN 'status'
      WHEN body_bytes_sent % 53 = 0 THEN 'size' END AS reason,
    right(remote_addr, 1) IN ('1', '3', '5', '7', '9') AS load
  FROM untimed
)
SELECT r.reason, count(l.reason) AS counted, nullif(count(l.reason), 0) AS stored,
  nullif(count(DISTINCT l.load), 0) AS loads
FROM (SELECT unnest(['no_address', 'short_line', 'surplus_fields', 'time', 'request', 'status',
                     'size']) AS reason) r LEFT JOIN lines l ON l.reason = r.reason
GROUP BY r.reason""",
    "high_water_mark": f'{_SILVER} SELECT max("timestamp") AS max_timestamp FROM silver',
    "incremental_new_rows": f"""{_LOG} SELECT {REQUEST_COLUMNS} FROM access_log
WHERE "timestamp" > (SELECT max("timestamp") FROM access_log WHERE "timestamp" <= {_CUT})""",
    "incremental_append": f"""{_SILVER} SELECT * FROM silver
WHERE method <> 'PUT' OR "timestamp" > (
  SELECT max("timestamp") FROM access_log WHERE "timestamp" <= {_CUT} AND method <> 'PUT')""",
    "incremental_stream": f"{_SILVER} SELECT * FROM silver",
    "incremental_stream_dedup": f"{_SILVER} SELECT * FROM silver",
    "incremental_stream_within": f"""{_SILVER}
SELECT remote_addr, "timestamp", method, url FROM silver
WHERE (method <> 'PUT' AND "timestamp" <= {_CUT}) OR "timestamp" > (
  SELECT max("timestamp") - INTERVAL 1 DAY FROM access_log
  WHERE "timestamp" <= {_CUT} AND method <> 'PUT')""",
    "time_range": f"""{_SILVER} SELECT count(*) AS row_count,
  min("timestamp") AS min_timestamp, max("timestamp") AS max_timestamp FROM silver""",
    "stg_requests": f"{_STAR} SELECT * FROM stg",
    **{t: f"{_STAR} SELECT * FROM {t}" for t in STAR_TABLES},
    **{name: f"{_STAR} {query}" for name, query in SUMMARIES.items()},
    **{f"rolled_{name}": f"{_STAR} {SUMMARIES[name]}" for name in (
        "kpi_summary", "agg_hourly_traffic", "agg_top_endpoints", "agg_daily_bytes")},
    "rolled_unique_requests": f"{_STAR} {_unique('fact_requests', 'request_id')}",
    "unique_addresses": f"""{_SILVER}
SELECT CAST(strftime("timestamp", '%Y%m%d') AS INT) AS "day",
  count(DISTINCT remote_addr) AS unique_ips
FROM silver WHERE status IS NOT NULL GROUP BY 1
UNION ALL SELECT NULL, count(DISTINCT remote_addr) FROM silver WHERE status IS NOT NULL""",
    "dq_unique": _STAR + " UNION ALL ".join(_unique(t, c) for t, c in _UNIQUE),
    "dq_not_null": _STAR + " UNION ALL ".join(
        [_not_null(t, c) for t, c in _NOT_NULL]
        + [_not_null(t, c, "source_not_null") for t, c in _SOURCE]),
    "dq_relationships": _STAR + " UNION ALL ".join(_related(c, p) for c, p in _RELATED),
    "dq_orphans": f"""{_STAR} SELECT ip_sk, count(*) AS n FROM fact_requests
WHERE ip_sk IS NOT NULL
  AND ip_sk NOT IN (SELECT ip_sk FROM dim_ip WHERE client_hostname IS NOT NULL)
GROUP BY ip_sk""",
    "enrich_hostnames_mixed_headers": f"{_SILVER} SELECT * FROM enriched",
    "enrich_unusable_lookup":
        f"{_LOG} SELECT {REQUEST_COLUMNS}, CAST(NULL AS VARCHAR) AS client_hostname FROM access_log",
    "silver_audit": f"""{_SILVER}
SELECT "year", "month", "day", count(*) AS row_count, min("timestamp") AS first_timestamp,
  max("timestamp") AS last_timestamp, true AS has_files
FROM silver GROUP BY ALL""",
    "bucketed_top_endpoints": f"{_STAR} {SUMMARIES['agg_top_endpoints']}",
    "summaries_in_order": _STAR + " " + " UNION ALL ".join(_placed(*o) for o in _ORDERS),
    "register_tables": _STAR + " " + " UNION ALL ".join(
        [_registered("silver", "present", "SELECT * FROM silver")]
        + [_registered(t, "registered", q) for t, q in _MODELS]),
    "model_tables": _STAR + " " + " UNION ALL ".join(
        _registered(t, "replaced", q) for t, q in _MODELS),
}
