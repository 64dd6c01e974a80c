"""SQL building blocks for the checks, written for DuckDB on the given tables."""

from __future__ import annotations

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
CUT = "TIMESTAMP '2024-01-30 00:00:00'"
ML_CUT = "TIMESTAMP '2024-01-29 00:00:00'"
FROM_30D = "TIMESTAMP '2024-01-01 00:00:00'"
ERR = "severity IN ('ERROR','CRITICAL')"
BAD = f"(CASE WHEN status_code >= 500 OR {ERR} THEN 1 ELSE 0 END)"
BIN = "time_bucket(INTERVAL '6 hours', ingest_ts)"

LOGS = """
e AS (SELECT *, ts >= TIMESTAMP '2024-01-30 00:00:00' AS inc FROM events),
f AS (SELECT *, (event_type = 'error' OR (inc AND event_type = 'click' AND user_id % 2 = 0)) AS fails FROM e),
logs AS (SELECT
  ts AS ingest_ts, ts AS source_ts,
  CASE event_type WHEN 'signup' THEN 'log-forwarder' WHEN 'view' THEN 'web-frontend' ELSE 'backend' END AS service,
  'production' AS environment,
  CASE WHEN inc THEN 'sha-new' ELSE 'sha-' || CAST(user_id % 3 AS VARCHAR) END AS deployment_sha,
  CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 3 = 0 THEN 'CRITICAL' ELSE 'ERROR' END
       WHEN fails THEN 'ERROR' ELSE 'INFO' END AS severity,
  CASE WHEN event_type = 'signup'
         THEN CASE WHEN user_id % 5 = 0 OR (inc AND user_id % 5 < 4) THEN 'message_skipped' ELSE 'batch_sent' END
       WHEN event_type = 'purchase' AND event_id % 20 = 0 THEN 'deployment' ELSE 'http_request' END AS event_type,
  CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
  '/api/r' || CAST(user_id % 2 AS VARCHAR) AS route,
  CASE WHEN event_type = 'signup' THEN NULL WHEN fails THEN 500 ELSE 200 END AS status_code,
  CASE WHEN event_type = 'signup' THEN NULL
       ELSE value * CASE WHEN inc AND user_id % 2 = 0 THEN 30.0e0 ELSE 10.0e0 END END AS duration_ms,
  't' || CAST(event_id AS VARCHAR) AS trace_id, 'q' || CAST(event_id AS VARCHAR) AS request_id,
  CASE WHEN fails THEN 'E' END AS error_type,
  CASE WHEN fails THEN 'failed on /api/r' || CAST(user_id % 2 AS VARCHAR) END AS error_message,
  CASE WHEN fails THEN 'E:/api/r' || CAST(user_id % 2 AS VARCHAR) END AS error_signature,
  CASE WHEN event_type = 'view' THEN '/page/' || CAST(user_id % 4 AS VARCHAR) END AS page,
  CASE WHEN event_type = 'view' THEN 'ok' END AS api_status,
  'events' AS source,
  'i' || CAST(event_id AS VARCHAR) AS insert_id, 'm' || CAST(event_id AS VARCHAR) AS pubsub_message_id,
  event_id
  FROM f)"""

VIEWS = f"""
http AS (SELECT * FROM logs WHERE event_type = 'http_request' AND service IS NOT NULL AND route IS NOT NULL),
errs AS (SELECT * FROM logs WHERE {ERR} AND error_signature IS NOT NULL),
deps AS (SELECT * FROM logs WHERE event_type = 'deployment'
         OR (event_type = 'forwarder_start' AND deployment_sha IS NOT NULL)),
fwd AS (SELECT * FROM logs WHERE service = 'log-forwarder'
        OR event_type IN ('forwarder_start','batch_sent','message_skipped'))"""

ROLLUPS = f"""
t1 AS (SELECT {BIN} AS time_bin, service || '::' || route AS series_key, service, route,
  COUNT(*) AS requests, CAST(SUM({BAD}) AS BIGINT) AS errors,
  CAST(SUM({BAD}) AS DOUBLE) / COUNT(*) AS error_rate
  FROM http WHERE ingest_ts >= {FROM_30D} GROUP BY 1, 2, 3, 4),
t2 AS (SELECT {BIN} AS time_bin, service || '::' || route AS series_key, service, route,
  COUNT(*) AS requests, AVG(duration_ms) AS avg_duration_ms,
  quantile_cont(duration_ms, 0.95) AS p95_duration_ms
  FROM http WHERE ingest_ts >= {FROM_30D} AND duration_ms IS NOT NULL GROUP BY 1, 2, 3, 4),
t3 AS (SELECT {BIN} AS time_bin, service || '::' || error_signature AS series_key, service, error_signature,
  COUNT(*) AS error_count FROM errs WHERE ingest_ts >= {FROM_30D} GROUP BY 1, 2, 3, 4),
t4 AS (SELECT {BIN} AS time_bin, 'forwarder_freshness' AS series_key, COUNT(*) AS healthy_events
  FROM fwd WHERE ingest_ts >= {FROM_30D} AND event_type = 'batch_sent' AND NOT ({ERR}) GROUP BY 1, 2),
t5 AS (SELECT {BIN} AS time_bin, 'forwarder_drops' AS series_key, COUNT(*) AS drop_count
  FROM fwd WHERE ingest_ts >= {FROM_30D} AND (event_type = 'message_skipped' OR {ERR}) GROUP BY 1, 2),
t6 AS (SELECT {BIN} AS time_bin, service || '::' || deployment_sha AS series_key, service, deployment_sha,
  COUNT(*) AS requests, CAST(SUM({BAD}) AS DOUBLE) / COUNT(*) AS error_rate
  FROM http WHERE ingest_ts >= {FROM_30D} AND deployment_sha IS NOT NULL GROUP BY 1, 2, 3, 4)"""


def _detector(n: int, table: str, signal: str, value: str, gate: str, requests: str, errors: str,
              service: str = "d.service", route: str = "d.route", sign: str = "") -> str:
    score = f"{sign}(d.{value} - b.m) / b.s"
    return f"""
b{n} AS (SELECT series_key, AVG({value}) AS m, stddev_samp({value}) AS s FROM {table}
  WHERE time_bin < {CUT} GROUP BY 1),
d{n} AS (SELECT d.time_bin, '{signal}' AS signal_type, {service} AS service, {route} AS route,
  CAST({requests} AS BIGINT) AS requests, CAST({errors} AS DOUBLE) AS errors,
  CAST(d.{value} AS DOUBLE) AS actual, b.m AS baseline_mean, b.s AS baseline_stddev,
  {score} AS anomaly_score
  FROM {table} d JOIN b{n} b USING (series_key)
  WHERE d.time_bin >= {CUT} AND {gate} AND b.s > 0 AND {score} >= 1.5)"""


SIGNALS = ",".join(
    [
        _detector(1, "t1", "backend_http_error_rate", "error_rate", "d.requests >= 5", "d.requests", "d.errors"),
        _detector(2, "t2", "route_latency_p95", "p95_duration_ms", "d.requests >= 5", "d.requests", "NULL"),
        _detector(3, "t3", "error_signature_spike", "error_count", "d.error_count >= 3", "NULL", "d.error_count",
                  route="d.error_signature"),
        _detector(4, "t4", "forwarder_freshness_drop", "healthy_events", "TRUE", "d.healthy_events", "0",
                  "'log-forwarder'", "'forwarder_freshness'", sign="-"),
        _detector(5, "t5", "forwarder_drop_failure", "drop_count", "TRUE", "0", "d.drop_count",
                  "'log-forwarder'", "'forwarder_drops'"),
        f"""
b6 AS (SELECT service, AVG(error_rate) AS m, stddev_samp(error_rate) AS s FROM t6
  WHERE time_bin < {CUT} GROUP BY 1),
r6 AS (SELECT service, deployment_sha, AVG(error_rate) AS a, CAST(SUM(requests) AS BIGINT) AS n FROM t6
  WHERE time_bin >= {CUT} GROUP BY 1, 2),
d6 AS (SELECT {AS_OF} AS time_bin, 'post_deployment_regression' AS signal_type, r.service,
  r.deployment_sha AS route, r.n AS requests, CAST(NULL AS DOUBLE) AS errors, r.a AS actual,
  b.m AS baseline_mean, b.s AS baseline_stddev, (r.a - b.m) / b.s AS anomaly_score
  FROM r6 r JOIN b6 b USING (service)
  WHERE r.n >= 20 AND b.s > 0 AND (r.a - b.m) / b.s >= 1.0)""",
        """
signals AS (SELECT * FROM d1 UNION ALL SELECT * FROM d2 UNION ALL SELECT * FROM d3
  UNION ALL SELECT * FROM d4 UNION ALL SELECT * FROM d5 UNION ALL SELECT * FROM d6)""",
    ]
)

ARTICLES = """
articles AS (SELECT CAST(doc_id AS VARCHAR) AS article_id, substring(text, 1, 60) AS title,
  CASE doc_id % 4 WHEN 0 THEN 'postmortem' WHEN 1 THEN 'runbook' WHEN 2 THEN 'architecture' ELSE 'faq' END AS category,
  source AS service, lang || ',' || source AS tags,
  CASE doc_id % 4 WHEN 0 THEN 'postmortem' WHEN 1 THEN 'runbook' WHEN 2 THEN 'architecture' ELSE 'faq' END || ' ' ||
  CASE doc_id % 5 WHEN 0 THEN 'remediation steps' WHEN 1 THEN 'root cause' WHEN 2 THEN 'similar incidents'
    WHEN 3 THEN 'failure' ELSE 'deployment' END || chr(10) || text AS body,
  TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id AS INTEGER)) AS updated_at FROM documents)"""

INDEX = """
words AS (SELECT article_id, term FROM (
  SELECT article_id, unnest(string_split_regex(lower(body), '[^a-z0-9]+')) AS term
  FROM articles WHERE body IS NOT NULL) WHERE term <> ''),
lens AS (SELECT a.article_id, COALESCE(w.n, 0) AS doc_len FROM articles a
  LEFT JOIN (SELECT article_id, COUNT(*) AS n FROM words GROUP BY 1) w USING (article_id) WHERE a.body IS NOT NULL),
postings AS (SELECT term, article_id, COUNT(*) AS tf FROM words GROUP BY 1, 2),
stats AS (SELECT COUNT(*) AS n, AVG(doc_len) AS mean_len FROM lens),
df AS (SELECT term, COUNT(*) AS df FROM postings GROUP BY 1)"""


def bm25(queries: str, k: int, keep: str = "TRUE") -> str:
    """CTEs from a ``queries`` relation (query_id, query) to ``hits``."""
    return f"""
asked AS ({queries}),
qterms AS (SELECT DISTINCT query_id, term FROM (
  SELECT query_id, unnest(string_split_regex(lower(query), '[^a-z0-9]+')) AS term FROM asked) WHERE term <> ''),
scored AS (SELECT q.query_id, p.article_id, round(SUM(
    ln(1 + (s.n - d.df + 0.5) / (d.df + 0.5)) * p.tf * 2.2 / (p.tf + 1.2 * (0.25 + 0.75 * l.doc_len / s.mean_len))
  ), 6) AS score
  FROM qterms q JOIN postings p USING (term) JOIN df d USING (term) JOIN lens l USING (article_id)
  JOIN articles a USING (article_id), stats s
  WHERE {keep} GROUP BY 1, 2),
hits AS (SELECT h.query_id, h.rank, h.article_id, a.title, a.category, a.service, a.tags, h.score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, article_id) AS INTEGER) AS rank
  FROM scored) h JOIN articles a USING (article_id) WHERE rank <= {k})"""


EVIDENCE = f"""
groups AS (SELECT service, route, error_signature, deployment_sha, COUNT(*) AS n, MAX(ingest_ts) AS last_seen
  FROM errs WHERE ingest_ts >= {CUT} GROUP BY 1, 2, 3, 4),
named AS (SELECT service, 'route' AS kind, route AS named, error_signature, deployment_sha, n, last_seen FROM groups
  UNION ALL SELECT service, 'error_signature', error_signature, error_signature, deployment_sha, n, last_seen FROM groups
  UNION ALL SELECT service, 'deployment_sha', deployment_sha, error_signature, deployment_sha, n, last_seen FROM groups),
series AS (SELECT DISTINCT signal_type, service, route, CASE signal_type WHEN 'error_signature_spike' THEN 'error_signature'
  WHEN 'post_deployment_regression' THEN 'deployment_sha' ELSE 'route' END AS kind FROM signals),
matched AS (SELECT s.signal_type, s.service, s.route, g.error_signature, g.deployment_sha,
  CAST(SUM(g.n) AS BIGINT) AS n, MAX(g.last_seen) AS last_seen
  FROM series s JOIN named g ON s.service = g.service AND s.kind = g.kind AND s.route = g.named GROUP BY 1, 2, 3, 4, 5),
evidence AS (SELECT *, CAST(row_number() OVER (PARTITION BY signal_type, service, route
    ORDER BY error_count DESC, error_signature) AS INTEGER) AS rank FROM (
  SELECT signal_type, service, route, error_signature, CAST(SUM(n) AS BIGINT) AS error_count,
    MAX(last_seen) AS last_seen, string_agg(DISTINCT deployment_sha, ', ' ORDER BY deployment_sha) AS deployment_shas
  FROM matched GROUP BY 1, 2, 3, 4)),
shas AS (SELECT signal_type, service, route, deployment_sha FROM (
  SELECT *, row_number() OVER (PARTITION BY signal_type, service, route ORDER BY n DESC, deployment_sha DESC) AS rn FROM (
    SELECT signal_type, service, route, deployment_sha, SUM(n) AS n FROM matched
    WHERE deployment_sha IS NOT NULL GROUP BY 1, 2, 3, 4)) WHERE rn = 1),
attached AS (SELECT s.*, CASE WHEN s.signal_type = 'post_deployment_regression' THEN s.route ELSE h.deployment_sha END
  AS deployment_sha FROM signals s LEFT JOIN shas h
  ON s.signal_type = h.signal_type AND s.service = h.service AND s.route = h.route),
open_incidents AS (SELECT DISTINCT service, route, deployment_sha FROM attached
  WHERE signal_type = 'error_signature_spike'),
candidates AS (SELECT * FROM attached a WHERE anomaly_score >= 2.0
  AND signal_type IN ('backend_http_error_rate','error_signature_spike','post_deployment_regression')
  AND deployment_sha IS NOT NULL AND NOT EXISTS (SELECT 1 FROM open_incidents o WHERE o.service = a.service
    AND o.route = a.route AND o.deployment_sha = a.deployment_sha)),
incidents AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY service, route, deployment_sha
  ORDER BY anomaly_score DESC, time_bin DESC, signal_type DESC) AS rn FROM candidates) WHERE rn = 1)"""

# what the deployment behind each signal tells; after EVIDENCE
RELEASE = f"""
released AS (SELECT *, lag(deployment_sha) OVER (PARTITION BY service ORDER BY deployed_at, deployment_sha) AS previous_sha FROM (
  SELECT service, deployment_sha, MIN(ingest_ts) AS deployed_at, arg_max(environment, ingest_ts) AS environment
  FROM deps WHERE ingest_ts >= {FROM_30D} AND deployment_sha IS NOT NULL GROUP BY 1, 2)),
release AS (SELECT o.signal_type, o.service, o.route, o.deployment_sha, r.deployed_at, r.environment, r.previous_sha,
  CAST(COALESCE(SUM(m.n), 0) AS BIGINT) AS errors,
  CAST(COALESCE(SUM(m.n) FILTER (WHERE m.deployment_sha = o.deployment_sha), 0) AS BIGINT) AS sha_errors,
  CAST(COALESCE(SUM(m.n) FILTER (WHERE m.deployment_sha = r.previous_sha), 0) AS BIGINT) AS previous_errors
  FROM (SELECT DISTINCT signal_type, service, route, deployment_sha FROM attached) o
  LEFT JOIN released r ON r.service = o.service AND r.deployment_sha = o.deployment_sha
  LEFT JOIN matched m ON m.signal_type = o.signal_type AND m.service = o.service AND m.route = o.route
  GROUP BY 1, 2, 3, 4, 5, 6, 7)"""


def model(table: str, value: str, route: str = "route") -> str:
    """CTEs of the trend + phase model: ``pts`` to ``forecasts``."""
    x = f"(epoch(time_bin) - epoch({AS_OF})) / 86400.0"
    phase = "CAST(floor((CAST(epoch(time_bin) AS BIGINT) % 86400) / 21600) AS BIGINT)"
    return f"""
pts AS (SELECT series_key, time_bin, CAST({value} AS DOUBLE) AS y, {x} AS x, {phase} AS phase FROM {table}
  WHERE time_bin < {ML_CUT}),
line AS (SELECT series_key, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM pts GROUP BY 1
  HAVING regr_slope(y, x) IS NOT NULL),
off_trend AS (SELECT p.series_key, p.phase, p.y - (l.intercept + l.slope * p.x) AS off
  FROM pts p JOIN line l USING (series_key)),
phases AS (SELECT series_key, phase, AVG(off) AS phase_level FROM off_trend GROUP BY 1, 2),
resids AS (SELECT series_key, off - phase_level AS resid FROM off_trend JOIN phases USING (series_key, phase)),
coefs AS (SELECT l.series_key, l.slope, l.intercept, r.sigma, r.points FROM line l JOIN (
  SELECT series_key, stddev_samp(resid) AS sigma, COUNT(*) AS points FROM resids GROUP BY 1) r USING (series_key)),
fresh AS (SELECT series_key, time_bin, service, {route} AS route, CAST({value} AS DOUBLE) AS y, {x} AS x,
  {phase} AS phase FROM {table} WHERE time_bin >= {ML_CUT}),
banded AS (SELECT n.time_bin AS ts, n.series_key, n.service, n.route, n.y, c.sigma,
  c.intercept + c.slope * n.x + COALESCE(p.phase_level, 0) AS forecast
  FROM fresh n JOIN coefs c USING (series_key) LEFT JOIN phases p USING (series_key, phase)),
forecasts AS (SELECT b.ts, b.series_key, b.service, b.route, b.y, b.forecast,
  b.forecast - 1.959963984540054 * b.sigma AS lower_bound, b.forecast + 1.959963984540054 * b.sigma AS upper_bound,
  abs(b.y - b.forecast) > 1.959963984540054 * b.sigma AS is_anomaly,
  (SELECT AVG(CASE WHEN r.resid <= b.y - b.forecast THEN 1.0e0 ELSE 0.0e0 END) FROM resids r
    WHERE r.series_key = b.series_key) AS percentile,
  CASE WHEN b.sigma > 0 THEN (b.y - b.forecast) / b.sigma END AS distance
  FROM banded b)"""


def detections(name: str, signal: str) -> str:
    return f"""
detections AS (SELECT {AS_OF} AS detected_at, '{name}' AS model_name, ts, series_key, service, route, y, forecast,
  lower_bound, upper_bound, is_anomaly, percentile, distance, '{signal}' AS signal_type FROM forecasts
  WHERE is_anomaly AND ts >= {CUT})"""


def with_(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


def logs(select: str) -> str:
    return with_(LOGS, VIEWS, select=select)


def rollups(select: str) -> str:
    return with_(LOGS, VIEWS, ROLLUPS, select=select)


def signals(select: str, *more: str) -> str:
    return with_(LOGS, VIEWS, ROLLUPS, SIGNALS, *more, select=select)


SIGNAL_LIST = """time_bin, signal_type, service, route, CAST(requests AS DOUBLE) AS requests, errors, round(actual, 6) AS actual,
  round(baseline_mean, 6) AS baseline_mean, round(baseline_stddev, 6) AS baseline_stddev,
  round(anomaly_score, 6) AS anomaly_score"""
T1_LIST = "time_bin, series_key, service, route, requests, errors, round(error_rate, 6) AS error_rate"
T2_LIST = """time_bin, series_key, service, route, requests, round(avg_duration_ms, 6) AS avg_duration_ms,
  round(p95_duration_ms, 6) AS p95_duration_ms"""
T6_LIST = "time_bin, series_key, service, deployment_sha, requests, round(error_rate, 6) AS error_rate"
FORECAST_LIST = """ts, series_key, service, route, round(y, 6) AS y, round(forecast, 6) AS forecast,
  round(lower_bound, 6) AS lower_bound, round(upper_bound, 6) AS upper_bound, is_anomaly,
  round(percentile, 6) AS percentile, round(distance, 6) AS distance"""
