"""Every registered query, next to the SQL that checks it.

A query takes the session and the folder of the given tables. Results are
shaped for comparison: instants without zone, doubles rounded to six places,
arrays as text.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from beaconlog.config import ts_lit
from beaconlog.functions import (
    distinct_list,
    div0,
    iso_z,
    parse_double,
    parse_number,
    parse_timestamp,
    series_key,
    split_part,
    time_bin,
    uniform_int,
)
from beaconlog.operators import alerts, article_index, detect, forecast, incidents, rollups, search, views
from beaconlog.plans import cycle, dashboard, evidence, metrics
from beaconlog.schemas import ML_DETECTION_COLUMNS, RAW_LOGS_COLUMNS, SIGNAL_COLUMNS, ddl, names
from beaconlog.session import fresh_dir, materialize, tune
from beaconlog.sources import adapters, json_logs, snapshots, tables
from beaconlog.sources.adapters import AS_OF, TABLE_CONFIG as CFG
from beaconlog.streaming import ingest, presence, refresh, silence, windows

from . import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


# whole numbers that can be NULL are compared as doubles, on both sides
NULLABLE_NUMBERS = ("status_code", "rounded", "too_wide")


def comparable(df: DataFrame) -> DataFrame:
    out = []
    for name, kind in df.dtypes:
        col = F.col(f"`{name}`")
        if kind == "timestamp":
            col = col.cast("timestamp_ntz")
        elif kind == "date":
            col = col.cast("string")
        elif name in NULLABLE_NUMBERS or (name == "requests" and "signal_type" in df.columns):
            col = col.cast("double")
        elif kind == "double":
            col = F.round(col, 6) + F.lit(0.0)
        elif kind == "array<string>":
            col = F.array_join(col, ",")
        out.append(col.alias(name))
    return df.select(*out)


def query(name: str, oracle: str | None = None):
    def register(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(tune(spark), sf_dir))

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


# ── shared inputs ───────────────────────────────────────────────────────────

logs = adapters.logs


def split(spark, sf, rollup) -> tuple[DataFrame, DataFrame]:
    """A roll-up of the logs before and inside the detection window."""
    past, recent = detect.split_logs(logs(spark, sf), AS_OF, CFG)
    return rollup(past, AS_OF, CFG), rollup(recent, AS_OF, CFG)


def signals(spark, sf) -> DataFrame:
    return detect.signals_from_logs(logs(spark, sf), AS_OF, CFG)


def stored_signals(spark, sf) -> DataFrame:
    """Signals as a stored table, as the cycle keeps them for later steps."""
    return materialize(signals(spark, sf), "signals")


def with_envelope(df: DataFrame) -> DataFrame:
    return df.withColumn("raw_envelope", F.lit(None).cast("variant")).select(*names(RAW_LOGS_COLUMNS))


def number(df: DataFrame):
    return F.expr("CAST(substring(insert_id, 2) AS BIGINT)")


def log_lines(spark, sf) -> DataFrame:
    """The logs as JSON lines in which numbers and times take many textual forms."""
    df = logs(spark, sf)
    n = number(df)
    micros = F.unix_micros("ingest_ts")
    iso = F.date_format("ingest_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    status = F.col("status_code").cast("string")
    return json_logs.to_envelope(
        df.withColumn(
            "ingest_ts",
            F.when(n % 4 == 1, micros.cast("string"))
            .when(n % 4 == 2, F.concat(micros.cast("string"), F.lit("000")))
            .otherwise(iso),
        )
        .withColumn(
            "source_ts",
            F.when(n % 5 == 0, "junk")
            .when(n % 5 == 1, F.floor(F.unix_seconds("source_ts")).cast("string"))
            .when(n % 5 == 2, F.unix_millis("source_ts").cast("string"))
            .otherwise(F.date_format("source_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS+00:00")),
        )
        .withColumn(
            "status_code",
            F.when(n % 6 == 0, F.concat(status, F.lit(".7")))
            .when(n % 6 == 1, "123456")
            .when(n % 6 == 2, "abc")
            .otherwise(status),
        )
        .withColumn(
            "duration_ms", F.when(n % 7 == 0, "").otherwise(F.col("duration_ms").cast("string"))
        )
    )


SOURCE_TS = """CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN date_trunc('second', source_ts)
  WHEN 2 THEN date_trunc('millisecond', source_ts) ELSE source_ts END"""
STATUS = "CASE event_id % 6 WHEN 0 THEN status_code + 1 WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE status_code END"
EXTRACTED = f"""SELECT ingest_ts, {SOURCE_TS} AS source_ts, service, environment, deployment_sha, severity,
  event_type, method, route, CAST({STATUS} AS DOUBLE) AS status_code,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE round(duration_ms, 6) END AS duration_ms, trace_id, request_id,
  error_type, error_message, error_signature, page, api_status, source, insert_id, pubsub_message_id FROM logs"""
LOG_LIST = """ingest_ts, source_ts, service, environment, deployment_sha, severity, event_type, method, route,
  CAST(status_code AS DOUBLE) AS status_code, round(duration_ms, 6) AS duration_ms, trace_id, request_id,
  error_type, error_message, error_signature, page, api_status, source, insert_id, pubsub_message_id"""


def log_folder(spark, sf) -> str:
    """The JSON lines as files: good ones, and one folder of broken lines per day."""
    folder = fresh_dir(spark, "log-files")
    log_lines(spark, sf).write.text(f"{folder}/good")
    df = logs(spark, sf).withColumn("day", F.date_format("ingest_ts", "yyyy-MM-dd"))
    broken = df.filter("event_type = 'message_skipped'").select(
        F.concat(F.lit('{"service":"'), F.col("service"), F.lit('", cut off')).alias("value"), "day"
    )
    broken.repartition("day").write.partitionBy("day").text(f"{folder}/broken")
    return folder


def plain(df: DataFrame) -> DataFrame:
    return df.select(*[n for n in names(RAW_LOGS_COLUMNS) if n != "raw_envelope"])


# ── sources, sinks, ingestion ───────────────────────────────────────────────

@query("read_log_files", sql.logs("""SELECT is_bad, COUNT(*) AS lines FROM (SELECT FALSE AS is_bad FROM logs
  UNION ALL SELECT TRUE FROM logs WHERE event_type = 'message_skipped') GROUP BY 1"""))
def _(spark, sf):
    lines = json_logs.read_log_files(spark, log_folder(spark, sf))
    return json_logs.parse_lines(lines).groupBy("is_bad").agg(F.count("*").alias("lines"))


@query("extract_log_rows", sql.logs(EXTRACTED))
def _(spark, sf):
    return plain(json_logs.extract_log_rows(log_lines(spark, sf)))


def ingested(spark, sf, **options) -> tuple[str, str]:
    out = fresh_dir(spark, "ingest")
    folder = log_folder(spark, sf)
    args = (spark, folder, f"{out}/raw", f"{out}/history", f"{out}/checkpoint")
    ingest.ingest_available(*args, **options)
    return out, folder


@query("stream_ingest", sql.logs(EXTRACTED))
def _(spark, sf):
    out, _ = ingested(spark, sf)
    return plain(tables.read_raw_logs(spark, f"{out}/raw"))


@query("ingest_available", sql.logs("""SELECT strftime(ingest_ts, '%Y-%m-%d') AS ingest_date, service,
  COUNT(*) AS log_rows, COUNT(DISTINCT insert_id) AS ids FROM logs GROUP BY 1, 2"""))
def _(spark, sf):
    # polled a second time: nothing is loaded twice
    out, folder = ingested(spark, sf)
    ingest.ingest_available(spark, folder, f"{out}/raw", f"{out}/history", f"{out}/checkpoint")
    raw = tables.read_raw_logs(spark, f"{out}/raw")
    return raw.groupBy("ingest_date", "service").agg(
        F.count("*").alias("log_rows"), F.countDistinct("insert_id").alias("ids")
    )


@query("refresh_files", sql.logs("SELECT service, COUNT(*) AS log_rows FROM logs GROUP BY 1"))
def _(spark, sf):
    # files from before the pipe are skipped by the stream and fetched by the rescan
    out, folder = ingested(spark, sf, refresh=False, started_at=AS_OF.replace(year=2100))
    ingest.refresh_files(spark, folder, f"{out}/raw", f"{out}/history", -1)
    ingest.refresh_files(spark, folder, f"{out}/raw", f"{out}/history", -2)
    return tables.read_raw_logs(spark, f"{out}/raw").groupBy("service").agg(F.count("*").alias("log_rows"))


@query("recent_load_errors", sql.logs("""SELECT 'Load failed' AS status,
  'day=' || strftime(ingest_ts, '%Y-%m-%d') AS folder, CAST(0 AS BIGINT) AS row_count, COUNT(*) AS error_count,
  'Error parsing JSON: {"service":"' || any_value(service) || '", cut off' AS first_error_message
  FROM logs WHERE event_type = 'message_skipped' GROUP BY 2 ORDER BY 2 LIMIT 25"""))
def _(spark, sf):
    out, _ = ingested(spark, sf)
    history = tables.read_load_history(spark, f"{out}/history")
    now = history.agg(F.max("last_load_time")).first()[0]
    return ingest.recent_load_errors(history, now).select(
        "status", F.regexp_extract("file_name", "day=[0-9-]+", 0).alias("folder"), "row_count", "error_count", "first_error_message"
    )


@query("load_history", sql.logs("""SELECT status, SUM(n)::BIGINT AS row_count, SUM(bad)::BIGINT AS error_count FROM (
  SELECT 'Loaded' AS status, 1 AS n, 0 AS bad FROM logs UNION ALL
  SELECT 'Load failed', 0, 1 FROM logs WHERE event_type = 'message_skipped') GROUP BY 1"""))
def _(spark, sf):
    out, _ = ingested(spark, sf)
    history = tables.read_load_history(spark, f"{out}/history")
    return history.groupBy("status").agg(
        F.sum("row_count").alias("row_count"), F.sum("error_count").alias("error_count")
    )


# copies: every failed request is logged again one second later, batches carry no id
COPIES = """d AS (SELECT * REPLACE (CASE WHEN event_type = 'batch_sent' THEN NULL ELSE insert_id END AS insert_id)
  FROM logs UNION ALL SELECT * REPLACE (ingest_ts + INTERVAL '1 second' AS ingest_ts) FROM logs
  WHERE error_signature IS NOT NULL)"""


@query("dedup_logs", sql.with_(sql.LOGS, COPIES, select="""SELECT * EXCLUDE (rn, event_id)
  REPLACE (round(duration_ms, 6) AS duration_ms, CAST(status_code AS DOUBLE) AS status_code) FROM (
  SELECT *, row_number() OVER (PARTITION BY insert_id ORDER BY ingest_ts) AS rn FROM d)
  WHERE rn = 1 OR insert_id IS NULL"""))
def _(spark, sf):
    df = logs(spark, sf)
    first = df.withColumn("insert_id", F.when(F.col("event_type") != "batch_sent", F.col("insert_id")))
    again = df.filter("error_signature IS NOT NULL").withColumn(
        "ingest_ts", F.col("ingest_ts") + F.expr("INTERVAL 1 SECOND")
    )
    return json_logs.dedup_logs(first.unionByName(again))


ALERT_ROW = """SELECT TIMESTAMP '2024-01-31 00:00:00' AS fired_at, least(COUNT(*), 10) AS signal_count,
  arg_max(signal_type, anomaly_score) AS top_signal, arg_max(service, anomaly_score) AS top_service,
  arg_max(route, anomaly_score) AS top_route, round(MAX(anomaly_score), 6) AS top_score,
  COUNT(*) AS total_count FROM signals WHERE anomaly_score >= 1.5 HAVING COUNT(*) > 0"""


@query("write_alert_log", sql.signals(ALERT_ROW))
def _(spark, sf):
    path = fresh_dir(spark, "alert-log")
    row = alerts.alert_log_row(signals(spark, sf), AS_OF, CFG)
    for _ in range(2):  # the second firing of the same cycle replaces the first
        tables.write_alert_log(row, path, AS_OF)
    return tables.read_alert_log(spark, path)


# ── views ───────────────────────────────────────────────────────────────────

@query("events_as_logs", sql.logs(f"SELECT {LOG_LIST} FROM logs"))
def _(spark, sf):
    return logs(spark, sf)


@query("http_requests", sql.logs("""SELECT ingest_ts, source_ts, service, environment, deployment_sha, severity,
  method, route, CAST(status_code AS DOUBLE) AS status_code, round(duration_ms, 6) AS duration_ms, trace_id,
  request_id FROM http"""))
def _(spark, sf):
    return views.http_requests(logs(spark, sf))


@query("application_errors", sql.logs("""SELECT ingest_ts, source_ts, service, environment, deployment_sha,
  severity, error_type, error_message, error_signature, route, trace_id, request_id FROM errs"""))
def _(spark, sf):
    return views.application_errors(logs(spark, sf))


@query("frontend_telemetry", sql.logs("""SELECT ingest_ts, source_ts, service, environment, page, api_status,
  round(duration_ms, 6) AS duration_ms, trace_id FROM logs WHERE service = 'web-frontend'"""))
def _(spark, sf):
    return views.frontend_telemetry(logs(spark, sf), CFG)


@query("deployments", sql.logs("""SELECT ingest_ts, source_ts, service, environment, deployment_sha, severity,
  source, event_type FROM deps"""))
def _(spark, sf):
    return views.deployments(logs(spark, sf))


@query("forwarder_health", sql.logs("""SELECT ingest_ts, source_ts, service, environment, event_type, severity,
  source FROM fwd"""))
def _(spark, sf):
    return views.forwarder_health(logs(spark, sf), CFG)


# ── roll-ups ────────────────────────────────────────────────────────────────

def _register_rollup(name: str, oracle: str) -> None:
    query(name, sql.rollups(oracle))(lambda spark, sf: rollups.ROLLUPS[name](logs(spark, sf), AS_OF, CFG))


_register_rollup("ts_http_error_rate", f"SELECT {sql.T1_LIST} FROM t1")
_register_rollup("ts_route_latency", f"SELECT {sql.T2_LIST} FROM t2")
_register_rollup("ts_error_signatures", "SELECT * FROM t3")
_register_rollup("ts_forwarder_freshness", "SELECT * FROM t4")
_register_rollup("ts_forwarder_drops", "SELECT * FROM t5")
_register_rollup("ts_deployment_error_rate", f"SELECT {sql.T6_LIST} FROM t6")


@query("route_latency_large_groups", sql.rollups(f"SELECT {sql.T2_LIST} FROM t2"))
def _(spark, sf):
    # from counts per duration, as the stream keeps them
    rows = rollups.since(logs(spark, sf), AS_OF, CFG.history, CFG).filter(views.is_http_request() & F.expr("duration_ms IS NOT NULL"))
    counts = rows.groupBy(time_bin("ingest_ts", CFG.bin_seconds).alias("time_bin"), "service", "route", "duration_ms")
    return windows.latency_from_counts(counts.agg(F.count("*").alias("n")), CFG)


def refreshed(spark, sf) -> tuple[str, str]:
    """Raw logs arriving in two waves, the second late, with bins kept up to date."""
    out = fresh_dir(spark, "refresh")
    raw, bins = f"{out}/raw", f"{out}/bins"
    df = with_envelope(logs(spark, sf))
    early = F.col("service") == "backend"
    for batch, rows in enumerate((df.filter(early), df.filter(~early))):
        tables.write_raw_logs(rows, raw, batch)
        refresh.refresh_bins(spark, raw, bins, refresh.touched_spans(rows, CFG), CFG)
    return raw, bins


@query("refresh_bins", sql.rollups(f"SELECT {sql.T1_LIST} FROM t1"))
def _(spark, sf):
    _, bins = refreshed(spark, sf)
    return refresh.stored_rollups(spark, bins)["ts_http_error_rate"]


@query("snapshot_commits", sql.rollups("""SELECT 'logs' AS stored, service, COUNT(*) AS stored_rows FROM logs
  WHERE service = 'backend' GROUP BY 1, 2 UNION ALL SELECT 'rates', service, COUNT(*) FROM t1 WHERE service = 'backend'
  GROUP BY 1, 2 UNION ALL SELECT 'latency', service, COUNT(*) FROM t2 WHERE service = 'backend' GROUP BY 1, 2"""))
def _(spark, sf):
    # a reader that started after the first wave: both kinds of bins belong to it, the second wave is not there yet
    out = fresh_dir(spark, "snapshots")
    raw, bins = f"{out}/raw", f"{out}/bins"
    df = with_envelope(logs(spark, sf))
    early = F.col("service") == "backend"

    def load(batch, rows):
        tables.write_raw_logs(rows, raw, batch)
        refresh.refresh_bins(spark, raw, bins, refresh.touched_spans(rows, CFG), CFG)

    load(0, df.filter(early))
    with snapshots.pinned(spark, out):
        # written while the reader is at work
        tables.write_raw_logs(df.filter(~early), raw, 1)
        seen = tables.read_raw_logs(spark, raw)
        stored = refresh.stored_rollups(spark, bins)
    frames = {"logs": seen, "rates": stored["ts_http_error_rate"], "latency": stored["ts_route_latency"]}
    counted = [f.groupBy("service").agg(F.count("*").alias("stored_rows")).withColumn("stored", F.lit(k)) for k, f in frames.items()]
    return functools.reduce(DataFrame.unionByName, counted)


@query("compact_tables", sql.logs("""SELECT strftime(ingest_ts, '%Y-%m-%d') AS ingest_date, service, COUNT(*) AS log_rows,
  TRUE AS few_parts FROM logs GROUP BY 1, 2"""))
def _(spark, sf):
    # every batch brings rows of every day; merged as they come
    out = fresh_dir(spark, "compaction")
    df, batches = with_envelope(logs(spark, sf)), 12
    for batch in range(batches):
        tables.write_raw_logs(df.filter(F.pmod(F.xxhash64("insert_id"), F.lit(batches)) == batch), f"{out}/raw_logs", batch)
        tables.compact_store(spark, out, fan_in=4)
    parts = snapshots.manifest(spark, out).tables["raw_logs"]
    days = {p.day for p in parts}
    few = max(sum(p.day == d for p in parts) for d in days) <= 6
    raw = tables.read_raw_logs(spark, f"{out}/raw_logs")
    return raw.groupBy("ingest_date", "service").agg(F.count("*").alias("log_rows")).withColumn("few_parts", F.lit(few))


# ── detectors ───────────────────────────────────────────────────────────────

def _register_detector(number: int, name: str, detector, rollup) -> None:
    def run(spark, sf):
        past, recent = split(spark, sf, rollup)
        return detector(past, AS_OF, CFG, recent)

    query(name, sql.signals(f"SELECT {sql.SIGNAL_LIST} FROM d{number}"))(run)


_register_detector(1, "backend_http_error_rate_anomalies", detect.backend_http_error_rate_anomalies,
                   rollups.ts_http_error_rate)
_register_detector(2, "route_latency_anomalies", detect.route_latency_anomalies, rollups.ts_route_latency)
_register_detector(3, "error_signature_spike_anomalies", detect.error_signature_spike_anomalies,
                   rollups.ts_error_signatures)
_register_detector(4, "forwarder_freshness_drop_anomalies", detect.forwarder_freshness_drop_anomalies,
                   rollups.ts_forwarder_freshness)
_register_detector(5, "forwarder_drop_failure_anomalies", detect.forwarder_drop_failure_anomalies,
                   rollups.ts_forwarder_drops)
_register_detector(6, "post_deployment_regression_anomalies", detect.post_deployment_regression_anomalies,
                   rollups.ts_deployment_error_rate)


@query("zscore_detect", sql.signals(f"SELECT {sql.SIGNAL_LIST} FROM signals"))
def _(spark, sf):
    # the generic operator over the union of all series
    return detect.zscore_detect(rollups.signal_rollup(logs(spark, sf), AS_OF, CFG), AS_OF, CFG)


@query("recent_anomaly_signals", sql.signals(f"SELECT {sql.SIGNAL_LIST} FROM signals"))
def _(spark, sf):
    return signals(spark, sf)


@query("recent_anomaly_signals_stored", sql.signals(f"SELECT {sql.SIGNAL_LIST} FROM signals"))
def _(spark, sf):
    _, bins = refreshed(spark, sf)
    return refresh.stored_signals(spark, bins, AS_OF, CFG)


TREND = f"""SELECT t.time_bin, t.series_key, t.service, t.route, t.requests,
  round((t.error_rate - b.m) / b.s, 2) AS z_score FROM t1 t JOIN b1 b USING (series_key)
  WHERE t.time_bin >= {sql.FROM_30D} AND b.s > 0 AND t.requests >= 5"""


@query("anomaly_score_trend", sql.signals(TREND))
def _(spark, sf):
    return detect.anomaly_score_trend(rollups.ts_http_error_rate(logs(spark, sf), AS_OF, CFG), AS_OF, CFG)


# ── forecast detector ───────────────────────────────────────────────────────

_MODEL_SQL = {
    "HTTP_ERROR_RATE_ANOMALY_MODEL": sql.model("t1", "error_rate"),
    "ROUTE_LATENCY_ANOMALY_MODEL": sql.model("t2", "p95_duration_ms"),
    "ERROR_SIGNATURE_ANOMALY_MODEL": sql.model("t3", "error_count", "error_signature"),
}
_SHORT = {
    "HTTP_ERROR_RATE_ANOMALY_MODEL": "error_rate",
    "ROUTE_LATENCY_ANOMALY_MODEL": "latency",
    "ERROR_SIGNATURE_ANOMALY_MODEL": "signatures",
}


def model_input(spark, sf, name):
    rollup, value, _ = forecast.MODELS[name]
    ts = materialize(rollups.ROLLUPS[rollup](logs(spark, sf), AS_OF, CFG), "bins")
    train = forecast.ml_train_input(ts, value, AS_OF, CFG)
    return train, forecast.ml_detect_input(ts, value, AS_OF, CFG)


def _register_model(name: str) -> None:
    rollup, value, signal = forecast.MODELS[name]
    short, ctes = _SHORT[name], _MODEL_SQL[name]
    table = {"ts_http_error_rate": "t1", "ts_route_latency": "t2", "ts_error_signatures": "t3"}[rollup]
    route = "error_signature AS route" if table == "t3" else "route"
    chosen = f"SELECT time_bin, series_key, service, {route}, round(CAST({value} AS DOUBLE), 6) AS y FROM {table}"

    def fitted(spark, sf):
        train, recent = model_input(spark, sf, name)
        return forecast.fit_series_model(train, AS_OF, CFG), recent

    query(f"ml_train_input_{short}", sql.rollups(f"{chosen} WHERE time_bin < {sql.ML_CUT}"))(
        lambda spark, sf: model_input(spark, sf, name)[0])
    query(f"ml_detect_input_{short}", sql.rollups(f"{chosen} WHERE time_bin >= {sql.ML_CUT}"))(
        lambda spark, sf: model_input(spark, sf, name)[1])
    query(f"fit_series_model_{short}", sql.with_(sql.LOGS, sql.VIEWS, sql.ROLLUPS, ctes, select="""
        SELECT c.series_key, round(slope, 6) AS slope, round(intercept, 6) AS intercept, round(sigma, 6) AS sigma,
        points, phase, round(phase_level, 6) AS phase_level FROM coefs c JOIN phases USING (series_key)"""))(
        lambda spark, sf: (lambda m: m.coef.drop("fitted_at").join(m.phase, "series_key"))(fitted(spark, sf)[0]))
    query(f"detect_anomalies_{short}", sql.with_(sql.LOGS, sql.VIEWS, sql.ROLLUPS, ctes,
                                                 select=f"SELECT {sql.FORECAST_LIST} FROM forecasts"))(
        lambda spark, sf: forecast.detect_anomalies(*fitted(spark, sf), CFG))
    query(f"run_detection_{short}", sql.with_(
        sql.LOGS, sql.VIEWS, sql.ROLLUPS, ctes, sql.detections(name, signal),
        select=f"SELECT detected_at, model_name, {sql.FORECAST_LIST}, signal_type FROM detections"))(
        lambda spark, sf: forecast.run_detection(name, *fitted(spark, sf), AS_OF, CFG))


for _name in forecast.MODELS:
    _register_model(_name)

_DETECTED = (sql.LOGS, sql.VIEWS, sql.ROLLUPS, _MODEL_SQL["ROUTE_LATENCY_ANOMALY_MODEL"],
             sql.detections("ROUTE_LATENCY_ANOMALY_MODEL", "route_latency_ml"))


def stored_detections(spark, sf) -> DataFrame:
    """Three runs, the last two over the same bins: overlapping and repeated."""
    name = "ROUTE_LATENCY_ANOMALY_MODEL"
    path = fresh_dir(spark, "detections")
    train, recent = model_input(spark, sf, name)
    model = forecast.fit_series_model(train, AS_OF, CFG)
    found = materialize(forecast.run_detection(name, model, recent, AS_OF, CFG), "found")
    earlier = found.withColumn("detected_at", ts_lit(AS_OF - timedelta(minutes=5)))
    tables.append_ml_detections(earlier, path, AS_OF - timedelta(minutes=5))
    tables.append_ml_detections(found, path, AS_OF)
    tables.append_ml_detections(found, path, AS_OF)
    return tables.read_ml_detections(spark, path)


@query("append_ml_detections", sql.with_(*_DETECTED, select=f"""SELECT detected_at, model_name, {sql.FORECAST_LIST},
  signal_type FROM (SELECT * FROM detections UNION ALL SELECT * REPLACE (detected_at - INTERVAL '5 minutes'
  AS detected_at) FROM detections)"""))
def _(spark, sf):
    return stored_detections(spark, sf).select(*names(ML_DETECTION_COLUMNS))


ML_SIGNALS = """SELECT ts AS time_bin, signal_type, service, route, CAST(NULL AS DOUBLE) AS requests,
  CAST(NULL AS DOUBLE) AS errors, round(y, 6) AS actual, round(forecast, 6) AS baseline_mean,
  CAST(NULL AS DOUBLE) AS baseline_stddev, round(distance, 6) AS anomaly_score, model_name, is_anomaly,
  round(percentile, 6) AS percentile FROM detections"""


@query("recent_anomaly_signals_ml", sql.with_(*_DETECTED, select=ML_SIGNALS))
def _(spark, sf):
    return forecast.recent_anomaly_signals_ml(stored_detections(spark, sf), AS_OF, CFG)


# ── alerts ──────────────────────────────────────────────────────────────────

TOP = """top AS (SELECT signal_type, service, route, CAST(requests AS DOUBLE) AS requests, errors, round(actual, 6) AS actual,
  round(baseline_mean, 6) AS baseline_mean, round(baseline_stddev, 6) AS baseline_stddev,
  round(anomaly_score, 6) AS anomaly_score, strftime(time_bin, '%Y-%m-%dT%H:%M:%SZ') AS time_bin
  FROM signals WHERE anomaly_score >= 1.5
  ORDER BY signals.anomaly_score DESC, signal_type, service, route, signals.time_bin LIMIT 10)"""


@query("alert_condition", sql.signals(f"""SELECT {sql.AS_OF} AS checked_at, COUNT(*) > 0 AS fires FROM signals
  WHERE anomaly_score >= 1.5"""))
def _(spark, sf):
    return alerts.alert_condition_row(signals(spark, sf), AS_OF, CFG)


@query("top_signals", sql.signals("SELECT * FROM top", TOP))
def _(spark, sf):
    return alerts.top_signals(signals(spark, sf), CFG)


@query("alert_log_row", sql.signals(ALERT_ROW))
def _(spark, sf):
    return alerts.alert_log_row(signals(spark, sf), AS_OF, CFG)


PAYLOAD_SQL = """SELECT 'anomaly_alert' AS source, '2024-01-31T00:00:00Z' AS fired_at,
  (SELECT COUNT(*) FROM top) AS signals, (SELECT COUNT(*) FROM top WHERE errors IS NULL) AS null_errors, top.*
  FROM top"""
_SIGNAL_JSON = ", ".join(
    f"{c.upper()} {'string' if c == 'time_bin' else dict(SIGNAL_COLUMNS)[c]}" for c in alerts.PAYLOAD_FIELDS
)


def read_payload(payloads: DataFrame) -> DataFrame:
    """The payload's JSON read back, one row per listed signal."""
    shape = f"source string, fired_at string, signals array<struct<{_SIGNAL_JSON}>>, top_signal struct<{_SIGNAL_JSON}>"
    shape = shape.replace("struct<" + _SIGNAL_JSON, "struct<" + ", ".join(
        p.replace(" ", ": ", 1) for p in _SIGNAL_JSON.split(", ")))
    body = payloads.select(F.from_json("payload", shape).alias("p"), "payload")
    listed = body.select(
        "p.source", "p.fired_at", F.size("p.signals").cast("bigint").alias("signals"),
        F.regexp_count("payload", F.lit('"ERRORS":null')).cast("bigint").alias("_nulls"),
        F.col("p.top_signal.ERRORS").isNull().cast("bigint").alias("_top_null"),
        F.explode("p.signals").alias("s"),
    )
    return listed.select(
        "source", "fired_at", "signals", (F.col("_nulls") - F.col("_top_null")).alias("null_errors"),
        *[F.col(f"s.{c.upper()}").alias(c) for c in alerts.PAYLOAD_FIELDS],
    )


@query("alert_payload", sql.signals(PAYLOAD_SQL, TOP))
def _(spark, sf):
    return read_payload(alerts.alert_payload(alerts.top_signals(signals(spark, sf), CFG), AS_OF))


@query("alert_backend_error_rate", sql.rollups(
    f"SELECT {sql.T1_LIST} FROM t1 WHERE time_bin >= {sql.CUT} AND error_rate > 0.05 AND requests >= 5"))
def _(spark, sf):
    _, recent = split(spark, sf, rollups.ts_http_error_rate)
    return alerts.alert_backend_error_rate(recent, AS_OF, CFG)


@query("alert_route_latency_high", sql.rollups(
    f"SELECT {sql.T2_LIST} FROM t2 WHERE time_bin >= {sql.CUT} AND p95_duration_ms > 500 AND requests >= 5"))
def _(spark, sf):
    _, recent = split(spark, sf, rollups.ts_route_latency)
    return alerts.alert_route_latency_high(recent, AS_OF, CFG)


SILENT = """SELECT TIMESTAMP '2024-02-05 00:00:00' AS checked_at, CAST(COUNT(*) AS BIGINT) AS batches FROM fwd
  WHERE event_type = 'batch_sent' AND ingest_ts >= TIMESTAMP '2024-02-04 00:00:00' HAVING COUNT(*) = 0"""


@query("alert_forwarder_silent", sql.logs(SILENT))
def _(spark, sf):
    return alerts.alert_forwarder_silent(logs(spark, sf), AS_OF + timedelta(days=5), CFG)


@query("evaluate_alerts", sql.signals(ALERT_ROW))
def _(spark, sf):
    out = fresh_dir(spark, "alerts")
    found = stored_signals(spark, sf)
    for _ in range(2):
        alerts.evaluate_alerts(spark, found, AS_OF, f"{out}/log", f"{out}/outbox", CFG)
    return tables.read_alert_log(spark, f"{out}/log")


@query("alert_outbox", sql.signals(PAYLOAD_SQL, TOP))
def _(spark, sf):
    out = fresh_dir(spark, "alerts")
    alerts.evaluate_alerts(spark, stored_signals(spark, sf), AS_OF, f"{out}/log", f"{out}/outbox", CFG)
    return read_payload(tables.read_outbox(spark, f"{out}/outbox"))


ML_ALERT = """SELECT TIMESTAMP '2024-01-31 00:00:00' AS fired_at, least(COUNT(*), 10) AS signal_count,
  arg_max(signal_type, distance) AS top_signal, arg_max(service, distance) AS top_service,
  arg_max(route, distance) AS top_route, round(MAX(distance), 6) AS top_score,
  COUNT(*) AS total_count FROM detections WHERE distance >= 1.5 HAVING COUNT(*) > 0"""


@query("alert_source", sql.with_(*_DETECTED, select=ML_ALERT))
def _(spark, sf):
    found = forecast.recent_anomaly_signals_ml(stored_detections(spark, sf), AS_OF, CFG)
    chosen = alerts.alert_source(detect.empty_signals(spark), found, use="forecast")
    return alerts.alert_log_row(chosen, AS_OF, CFG)


# ── dashboard tiles ─────────────────────────────────────────────────────────

def _register_tile(name: str, oracle: str) -> None:
    query(name, sql.logs(oracle))(lambda spark, sf: getattr(dashboard, name)(logs(spark, sf), AS_OF, CFG))


SINCE = f"ingest_ts >= {sql.FROM_30D}"
_register_tile("tile_error_rate_by_service", f"""SELECT service, COUNT(*) AS total_requests,
  CAST(SUM({sql.BAD}) AS BIGINT) AS error_count, round(SUM({sql.BAD}) * 1.0e0 / COUNT(*) * 100, 2) AS error_rate_pct
  FROM http WHERE {SINCE} GROUP BY 1""")
_register_tile("tile_request_rate", f"""SELECT {sql.BIN} AS time_bin, service, COUNT(*) AS requests FROM http
  WHERE {SINCE} GROUP BY 1, 2""")
_register_tile("tile_p95_by_route", f"""SELECT route, service, COUNT(*) AS requests,
  round(AVG(duration_ms), 1) AS avg_ms, round(quantile_cont(duration_ms, 0.95), 1) AS p95_ms FROM http
  WHERE {SINCE} AND duration_ms IS NOT NULL GROUP BY 1, 2 ORDER BY p95_ms DESC, route, service LIMIT 20""")
_register_tile("tile_top_error_signatures", f"""SELECT service, error_signature, COUNT(*) AS error_count,
  MIN(ingest_ts) AS first_seen, MAX(ingest_ts) AS last_seen,
  string_agg(DISTINCT deployment_sha, ', ' ORDER BY deployment_sha) AS deployment_shas FROM errs
  WHERE {SINCE} GROUP BY 1, 2 ORDER BY error_count DESC, service, error_signature LIMIT 25""")
_register_tile("tile_recent_deployments", f"""SELECT ingest_ts, service, environment, deployment_sha, event_type
  FROM deps WHERE {SINCE} ORDER BY ingest_ts DESC, service, environment, deployment_sha, event_type LIMIT 30""")
_register_tile("tile_forwarder_health", f"""SELECT {sql.BIN} AS time_bin, event_type, COUNT(*) AS event_count
  FROM fwd WHERE {SINCE} GROUP BY 1, 2""")
_register_tile("tile_error_rate_by_route_sha", f"""SELECT service, deployment_sha, route, COUNT(*) AS requests,
  CAST(SUM({sql.BAD}) AS BIGINT) AS errors, round(SUM({sql.BAD}) * 1.0e0 / COUNT(*) * 100, 2) AS error_rate_pct
  FROM http WHERE {SINCE} AND deployment_sha IS NOT NULL GROUP BY 1, 2, 3 HAVING COUNT(*) >= 10
  ORDER BY error_rate_pct DESC, service, deployment_sha, route LIMIT 30""")


@query("tile_current_signals", sql.signals("""SELECT time_bin, signal_type, service, route,
  round(anomaly_score, 2) AS anomaly_score, round(actual, 4) AS actual, round(baseline_mean, 4) AS baseline,
  CAST(requests AS DOUBLE) AS requests FROM signals"""))
def _(spark, sf):
    return dashboard.tile_current_signals(signals(spark, sf))


@query("tile_anomaly_trend", sql.signals(TREND))
def _(spark, sf):
    return dashboard.tile_anomaly_trend(rollups.ts_http_error_rate(logs(spark, sf), AS_OF, CFG), AS_OF, CFG)


# ── metrics and evidence ────────────────────────────────────────────────────

MONTH = timedelta(days=30)


@query("metric_query_requests", sql.logs(f"""SELECT service, route, method,
  CAST(status_code AS DOUBLE) AS status_code, deployment_sha, environment,
  COUNT(*) AS request_count, CAST(SUM({sql.BAD}) AS BIGINT) AS error_count,
  round(SUM(CASE WHEN status_code >= 500 THEN 1.0e0 ELSE 0 END) / COUNT(*), 6) AS error_rate,
  round(AVG(duration_ms), 6) AS avg_latency_ms, round(quantile_cont(duration_ms, 0.95), 6) AS p95_latency_ms
  FROM http WHERE {SINCE} GROUP BY 1, 2, 3, 4, 5, 6"""))
def _(spark, sf):
    return metrics.metric_query(
        logs(spark, sf), "http_requests",
        ["request_count", "error_count", "error_rate", "avg_latency_ms", "p95_latency_ms"],
        list(metrics.METRICS["http_requests"].dimensions), AS_OF, MONTH, cfg=CFG)


@query("metric_query_requests_daily", sql.logs("""SELECT time_bucket(INTERVAL '1 day', source_ts) AS source_ts,
  service, COUNT(*) AS request_count, round(quantile_cont(duration_ms, 0.95), 6) AS p95_latency_ms
  FROM http GROUP BY 1, 2"""))
def _(spark, sf):
    return metrics.metric_query(logs(spark, sf), "http_requests", ["request_count", "p95_latency_ms"], ["service"],
                                grain_seconds=86400, time="source_ts", cfg=CFG)


@query("metric_query_filtered", sql.logs(f"""SELECT service, time_bucket(INTERVAL '6 hours', ingest_ts) AS ingest_ts,
  COUNT(*) AS request_count, round(quantile_cont(duration_ms, 0.95), 6) AS p95_latency_ms
  FROM http WHERE {SINCE} AND method = 'GET' AND status_code < 500 GROUP BY 1, 2
  ORDER BY request_count DESC, service, 2 LIMIT 25"""))
def _(spark, sf):
    # filters, a grain within a window, order and limit
    return metrics.metric_query(
        logs(spark, sf), "http_requests", ["request_count", "p95_latency_ms"], ["service"], AS_OF, MONTH,
        filters=[F.col("method") == "GET", F.col("status_code") < 500], grain_seconds=21600, time="ingest_ts",
        order=[F.desc("request_count"), F.col("service"), F.col("ingest_ts")], limit=25, cfg=CFG)


@query("metric_query_total", sql.logs("""SELECT COUNT(*) AS request_count,
  round(quantile_cont(duration_ms, 0.95), 6) AS p95_latency_ms FROM http"""))
def _(spark, sf):
    # one group holding every request
    return metrics.metric_query(logs(spark, sf), "http_requests", ["request_count", "p95_latency_ms"], cfg=CFG)


@query("metric_query_errors", sql.logs(f"""SELECT service, error_signature, error_type, error_message, deployment_sha,
  severity, COUNT(*) AS error_count FROM errs WHERE {SINCE} GROUP BY 1, 2, 3, 4, 5, 6"""))
def _(spark, sf):
    return metrics.metric_query(logs(spark, sf), "application_errors", ["error_count"],
                                list(metrics.METRICS["application_errors"].dimensions), AS_OF, MONTH, cfg=CFG)


@query("metric_query_signals", sql.signals("""SELECT signal_type, service, route,
  round(MAX(anomaly_score), 6) AS anomaly_score, COUNT(*) AS signal_count FROM signals GROUP BY 1, 2, 3"""))
def _(spark, sf):
    return metrics.metric_query(signals(spark, sf), "signals", ["anomaly_score", "signal_count"],
                                ["signal_type", "service", "route"])


@query("vq_error_rate_last_hour", sql.logs(f"""SELECT service, COUNT(*) AS requests,
  CAST(SUM({sql.BAD}) AS BIGINT) AS errors,
  round(SUM(CASE WHEN status_code >= 500 THEN 1.0e0 ELSE 0 END) / COUNT(*) * 100, 2) AS error_rate_pct
  FROM http WHERE {SINCE} GROUP BY 1"""))
def _(spark, sf):
    return metrics.vq_error_rate_last_hour(logs(spark, sf), AS_OF, CFG, MONTH)


@query("vq_top_errors_last_30min", sql.logs(f"""SELECT service, error_signature, COUNT(*) AS error_count,
  MAX(ingest_ts) AS last_seen FROM errs WHERE {SINCE} GROUP BY 1, 2
  ORDER BY error_count DESC, service, error_signature LIMIT 10"""))
def _(spark, sf):
    return metrics.vq_top_errors_last_30min(logs(spark, sf), AS_OF, CFG, MONTH)


@query("vq_recent_deployments", sql.logs(f"""SELECT service, deployment_sha, ingest_ts, environment FROM deps
  WHERE {SINCE}"""))
def _(spark, sf):
    return metrics.vq_recent_deployments(logs(spark, sf), AS_OF, CFG, MONTH)


@query("vq_active_signals", sql.signals("""SELECT signal_type, service, route, round(anomaly_score, 2) AS anomaly_score,
  round(actual, 4) AS actual, round(baseline_mean, 4) AS baseline FROM signals"""))
def _(spark, sf):
    return metrics.vq_active_signals(signals(spark, sf))


@query("evidence_errors", sql.signals("SELECT * FROM evidence WHERE rank <= 10", sql.EVIDENCE))
def _(spark, sf):
    return evidence.evidence_errors(stored_signals(spark, sf), logs(spark, sf), AS_OF, CFG)


@query("evidence_top_routes", sql.logs(f"""SELECT service, route, COUNT(*) AS requests,
  CAST(SUM({sql.BAD}) AS BIGINT) AS errors, round(SUM({sql.BAD}) * 1.0e0 / COUNT(*) * 100, 2) AS error_rate_pct
  FROM http WHERE ingest_ts >= {sql.CUT} GROUP BY 1, 2
  ORDER BY error_rate_pct DESC, requests DESC, service, route LIMIT 10"""))
def _(spark, sf):
    return evidence.evidence_top_routes(logs(spark, sf), AS_OF, CFG)


@query("evidence_sha_trend", sql.rollups("""SELECT time_bin, t6.service, t6.deployment_sha, requests,
  round(error_rate, 6) AS error_rate FROM t6 JOIN (
  SELECT service, deployment_sha, row_number() OVER (PARTITION BY service ORDER BY ingest_ts DESC, deployment_sha DESC)
  AS rn FROM http WHERE deployment_sha IS NOT NULL) l
  ON l.rn = 1 AND l.service = t6.service AND l.deployment_sha = t6.deployment_sha"""))
def _(spark, sf):
    latest = rollups.latest_shas(logs(spark, sf), AS_OF, CFG)
    return evidence.evidence_sha_trend(rollups.ts_deployment_error_rate(logs(spark, sf), AS_OF, CFG), latest)


@query("related_signals", sql.signals("""SELECT a.signal_type, a.service, a.route, b.signal_type AS related_type,
  b.bins AS related_bins, round(b.m, 6) AS related_max_score FROM
  (SELECT DISTINCT signal_type, service, route FROM signals) a JOIN
  (SELECT signal_type, service, route, COUNT(*) AS bins, MAX(anomaly_score) AS m FROM signals GROUP BY 1, 2, 3) b
  ON a.service = b.service AND a.route = b.route AND a.signal_type <> b.signal_type"""))
def _(spark, sf):
    return evidence.related_signals(stored_signals(spark, sf))


# ── article search ──────────────────────────────────────────────────────────

BENCH_QUERIES = "SELECT CAST(item_id AS VARCHAR) AS query_id, text AS query FROM benchmark"


def bench_queries(spark, sf) -> DataFrame:
    df = spark.read.schema("item_id bigint, text string").parquet(f"{sf}/benchmark.parquet")
    return df.select(F.col("item_id").cast("string").alias("query_id"), F.col("text").alias("query"))


@query("documents_as_articles", sql.with_(sql.ARTICLES, select="""SELECT article_id, title, category, service, tags,
  body, updated_at FROM articles"""))
def _(spark, sf):
    return adapters.articles(spark, sf).drop("authored_at")


@query("build_article_index", sql.with_(sql.ARTICLES, sql.INDEX, select="""SELECT term, article_id, tf, doc_len
  FROM postings JOIN lens USING (article_id)"""))
def _(spark, sf):
    return search.build_article_index(adapters.articles(spark, sf)).postings


@query("article_index_docs", sql.with_(sql.ARTICLES, sql.INDEX, select="""SELECT article_id, title, category, service,
  tags, doc_len FROM lens JOIN articles USING (article_id)"""))
def _(spark, sf):
    return search.build_article_index(adapters.articles(spark, sf)).docs


@query("refresh_article_index", sql.with_(sql.ARTICLES, sql.INDEX, sql.bm25(BENCH_QUERIES, 5),
                                          select="SELECT * FROM hits"))
def _(spark, sf):
    # an index in which every third article is outdated, then refreshed
    path = fresh_dir(spark, "index")
    now = adapters.articles(spark, sf)
    outdated = F.pmod(F.col("article_id").cast("bigint"), F.lit(3)) == 0
    clock = F.when(outdated, ts_lit(AS_OF)).otherwise(F.col("updated_at"))
    drafts = now.withColumn("body", F.when(outdated, F.lit("draft")).otherwise(F.col("body")))
    article_index.save_article_index(drafts, path, buckets=16)
    article_index.refresh_article_index(now.withColumn("updated_at", clock), path, ts_lit(AS_OF))
    return article_index.search_index(article_index.load_article_index(spark, path), bench_queries(spark, sf), k=5)


@query("search_article_index", sql.with_(
    sql.ARTICLES, sql.INDEX,
    sql.bm25(BENCH_QUERIES, 3, "a.category IN ('runbook','postmortem') AND a.tags LIKE 'en,%'"),
    select="SELECT * FROM hits"))
def _(spark, sf):
    path = fresh_dir(spark, "index")
    article_index.save_article_index(adapters.articles(spark, sf), path, buckets=16)
    index = article_index.load_article_index(spark, path)
    return article_index.search_index(index, bench_queries(spark, sf), 3, {"category": ["runbook", "postmortem"], "tags": "en"})


@query("search_articles", sql.with_(sql.ARTICLES, sql.INDEX, sql.bm25(BENCH_QUERIES, 5), select="SELECT * FROM hits"))
def _(spark, sf):
    return search.search_articles(bench_queries(spark, sf), adapters.articles(spark, sf))


@query("search_articles_filtered", sql.with_(
    sql.ARTICLES, sql.INDEX,
    sql.bm25(BENCH_QUERIES, 3, "a.category IN ('runbook','postmortem') AND a.tags LIKE 'en,%'"),
    select="SELECT * FROM hits"))
def _(spark, sf):
    return search.search_articles(bench_queries(spark, sf), adapters.articles(spark, sf), 3,
                                  {"category": ["runbook", "postmortem"], "tags": "en"})


# The search texts of a signal.
SIGNAL_QUERIES = """sq AS (SELECT DISTINCT signal_type, service, route, variant, query, sha256(query) AS query_id FROM (
  SELECT signal_type, service, route, 0 AS variant,
    signal_type || ' ' || service || ' ' || route || ' runbook remediation root cause' AS query FROM signals
  UNION ALL SELECT signal_type, service, route, 1, signal_type || ' failure root cause' FROM signals
  UNION ALL SELECT signal_type, service, route, 2, signal_type || ' runbook remediation steps' FROM signals
  UNION ALL SELECT signal_type, service, route, 3, 'similar incidents ' || signal_type FROM signals))"""


@query("signal_search_queries", sql.signals("SELECT * FROM sq", SIGNAL_QUERIES))
def _(spark, sf):
    return search.signal_search_queries(signals(spark, sf), variants=True)


@query("search_articles_for_signals", sql.signals(
    "SELECT * FROM hits", SIGNAL_QUERIES, sql.ARTICLES, sql.INDEX,
    sql.bm25("SELECT DISTINCT query_id, query FROM sq", 5)))
def _(spark, sf):
    asked = search.signal_search_queries(stored_signals(spark, sf), variants=True)
    return search.search_articles(asked.select("query_id", "query").distinct(), adapters.articles(spark, sf))


@query("search_snippet", sql.with_(sql.ARTICLES, select="""SELECT article_id,
  CASE WHEN body IS NULL OR body = '' THEN '(no body)' ELSE substring(body, 1, 300) || '...' END AS snippet
  FROM articles"""))
def _(spark, sf):
    return adapters.articles(spark, sf).select("article_id", search.search_snippet(F.col("body")).alias("snippet"))


@query("search_articles_dense", """WITH q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE vec_id % 50 = 0),
  s AS (SELECT query_id, vec_id, round(list_cosine_similarity(v, CAST(embedding AS DOUBLE[])), 9) AS score FROM q, embeddings)
  SELECT query_id, vec_id, round(score, 6) AS score, rank FROM (SELECT *, CAST(row_number() OVER (
    PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s) WHERE rank <= 5""")
def _(spark, sf):
    # every row whose id is divisible by 50, against all rows
    vectors = adapters.embeddings(spark, sf)
    asked = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return search.search_articles_dense(asked, vectors)


# ── incidents ───────────────────────────────────────────────────────────────

def open_incidents(spark, sf) -> DataFrame:
    """Incidents that earlier signature spikes have opened: some of today's candidates among them."""
    spikes = attached(spark, sf).filter("signal_type = 'error_signature_spike'")
    return spikes.select("service", "route", "deployment_sha").distinct()


def attached(spark, sf) -> DataFrame:
    found = stored_signals(spark, sf)
    return incidents.attach_deployment(found, evidence.evidence_shas(found, logs(spark, sf), AS_OF, CFG))


@query("evidence_shas", sql.signals("SELECT * FROM shas", sql.EVIDENCE))
def _(spark, sf):
    return evidence.evidence_shas(stored_signals(spark, sf), logs(spark, sf), AS_OF, CFG)


@query("attach_deployment", sql.signals(f"SELECT {sql.SIGNAL_LIST}, deployment_sha FROM attached", sql.EVIDENCE))
def _(spark, sf):
    return attached(spark, sf)


@query("remediation_candidates", sql.signals(
    f"SELECT {sql.SIGNAL_LIST}, deployment_sha FROM candidates", sql.EVIDENCE))
def _(spark, sf):
    return incidents.remediation_candidates(attached(spark, sf), open_incidents(spark, sf), CFG)


@query("dedup_incidents", sql.signals(f"SELECT {sql.SIGNAL_LIST}, deployment_sha FROM incidents", sql.EVIDENCE))
def _(spark, sf):
    found = incidents.remediation_candidates(attached(spark, sf), open_incidents(spark, sf), CFG)
    return incidents.dedup_incidents(found)


# signals and clues as a graph; a cause is what can be reached
CAUSES = """
nodes AS (SELECT DISTINCT signal_type, service, route, deployment_sha FROM attached WHERE anomaly_score >= 2.0
  AND signal_type IN ('backend_http_error_rate','error_signature_spike','post_deployment_regression')
  AND deployment_sha IS NOT NULL),
clues AS (SELECT *, 'sha|' || service || '|' || deployment_sha AS clue FROM nodes UNION ALL
  SELECT *, 'route|' || service || '|' || CASE signal_type WHEN 'post_deployment_regression' THEN NULL
    WHEN 'error_signature_spike' THEN nullif(regexp_extract(route, ':(/.*)$', 1), '') ELSE route END FROM nodes),
near AS (SELECT DISTINCT a.clue, b.clue AS other FROM clues a JOIN clues b USING (signal_type, service, route, deployment_sha)
  WHERE a.clue IS NOT NULL AND b.clue IS NOT NULL),
reach(clue, other) AS (SELECT clue, other FROM near UNION SELECT r.clue, n.other FROM reach r JOIN near n ON n.clue = r.other),
causes AS (SELECT c.signal_type, c.service, c.route, c.deployment_sha, MIN(r.other) AS cause
  FROM clues c JOIN reach r ON r.clue = c.clue GROUP BY 1, 2, 3, 4),
grouped AS (SELECT a.*, cause, COUNT(DISTINCT (signal_type, service, route, deployment_sha)) OVER (PARTITION BY cause) AS signals,
  row_number() OVER (PARTITION BY cause ORDER BY round(anomaly_score, 9) DESC, time_bin DESC, signal_type DESC, route DESC) AS rn
  FROM attached a JOIN causes USING (signal_type, service, route, deployment_sha) WHERE anomaly_score >= 2.0)"""


@query("group_incidents", sql.signals(f"SELECT {sql.SIGNAL_LIST}, deployment_sha, signals FROM grouped WHERE rn = 1",
                                      sql.EVIDENCE, CAUSES).replace("WITH ", "WITH RECURSIVE ", 1))
def _(spark, sf):
    strong = incidents.remediation_candidates(attached(spark, sf), open_incidents(spark, sf).limit(0), CFG)
    return incidents.group_incidents(strong, open_incidents(spark, sf).limit(0)).drop("incident_id")


@query("evidence_release", sql.signals("SELECT * FROM release", sql.EVIDENCE, sql.RELEASE))
def _(spark, sf):
    return evidence.evidence_release(attached(spark, sf), logs(spark, sf), AS_OF, CFG)


def _shown(column: str) -> str:
    return f"""CASE WHEN signal_type IN ('backend_http_error_rate','post_deployment_regression')
  THEN printf('%.1f%%', round({column} * 100, 1)) ELSE printf('%.1f', round({column}, 1)) END"""


REPORT = f"""
lines AS (SELECT signal_type, service, route, string_agg('- ' || error_signature || ': ' || error_count ||
  ' errors, last seen ' || strftime(last_seen, '%Y-%m-%dT%H:%M:%SZ') || ', SHAs ' || deployment_shas,
  chr(10) ORDER BY rank) AS txt FROM evidence WHERE rank <= 10 GROUP BY 1, 2, 3),
iq AS (SELECT DISTINCT signal_type, service, route, signal_type || ' ' || service || ' ' || route ||
  ' runbook remediation root cause' AS query FROM incidents),
report AS (SELECT '[Anomaly] ' || CASE signal_type WHEN 'backend_http_error_rate' THEN 'Backend HTTP Error Rate'
    WHEN 'error_signature_spike' THEN 'Error Signature Spike' ELSE 'Post Deployment Regression' END ||
    ' - ' || route || ' (z=' || printf('%.2f', round(anomaly_score, 2)) || ')' AS title,
  signal_type, service, route, deployment_sha, round(anomaly_score, 6) AS anomaly_score,
  'Signal: ' || signal_type || chr(10) || 'Service: ' || service || ' | Route: ' || route || chr(10) ||
  'Anomaly score: ' || printf('%.2f', round(anomaly_score, 2)) || ' (threshold 1.5)' || chr(10) ||
  'Actual: ' || {_shown('actual')} || ' | Baseline mean: ' || {_shown('baseline_mean')} ||
  ' | Baseline stddev: ' || {_shown('baseline_stddev')} || chr(10) ||
  'Detection window: last 1 day | Baseline window: last 30 days' || chr(10) ||
  'Fired at: 2024-01-31T00:00:00Z' || chr(10) || 'Evidence:' || chr(10) ||
  COALESCE(lines.txt, 'no matching errors') || chr(10) || 'Errors on SHA ' || deployment_sha || ': ' || sha_errors || ' of ' ||
  errors_of || CASE WHEN errors_of > 0 THEN ' (' || printf('%.1f%%', round(100.0 * sha_errors / errors_of, 1)) || ')' ELSE '' END || chr(10) ||
  'Deployed: ' || COALESCE(strftime(deployed_at, '%Y-%m-%dT%H:%M:%SZ') || ' to ' || env_of, 'unknown') ||
  ' | Previous SHA: ' || COALESCE(previous_sha || ' with ' || previous_errors || ' errors', 'none') || chr(10) || COALESCE('Related article: ' || a.title || chr(10) ||
    CASE WHEN a.body IS NULL OR a.body = '' THEN '(no body)' ELSE substring(a.body, 1, 300) || '...' END,
    'Related article: none') AS body,
  'observability, anomaly, critical' AS labels, {sql.AS_OF} AS fired_at
  FROM incidents LEFT JOIN (SELECT signal_type, service, route, deployment_sha, deployed_at, environment AS env_of, previous_sha,
    errors AS errors_of, sha_errors, previous_errors FROM release) USING (signal_type, service, route, deployment_sha)
  LEFT JOIN lines USING (signal_type, service, route)
  LEFT JOIN iq USING (signal_type, service, route) LEFT JOIN hits h ON h.query_id = iq.query
  LEFT JOIN articles a ON a.article_id = h.article_id)"""


@query("incident_report", sql.signals(
    "SELECT * FROM report", sql.EVIDENCE, sql.RELEASE, sql.ARTICLES, sql.INDEX,
    REPORT.replace("\nreport AS", sql.bm25("SELECT DISTINCT query AS query_id, query FROM iq", 1) + ",\nreport AS")))
def _(spark, sf):
    return cycle.build_incidents(stored_signals(spark, sf), logs(spark, sf), open_incidents(spark, sf), AS_OF, CFG,
                                 adapters.articles(spark, sf))


# ── streaming ───────────────────────────────────────────────────────────────

def event_stream(spark, sf) -> DataFrame:
    """The events table read as a stream of files, mapped to logs."""
    df = spark.readStream.schema(adapters.EVENTS).option("pathGlobFilter", "events.parquet").parquet(sf)
    return adapters.events_as_logs(df)


def drain(spark, stream: DataFrame, keys: list[str]) -> DataFrame:
    """Run a stream over what is available; its latest row per key."""
    out = fresh_dir(spark, "stream")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")

    stream.writeStream.outputMode("update").foreachBatch(write).option(
        "checkpointLocation", f"{out}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    rows = tables.read_table(spark, f"{out}/rows", ddl(stream.dtypes) + ", batch_id bigint")
    rest = [c for c in stream.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_r")).select(
        *keys, "_r.*").select(*stream.columns)


LATE = "40 days"  # nothing in the given month counts as late


def _register_window(name: str, keys: list[str], oracle: str) -> None:
    query(name, sql.rollups(oracle))(
        lambda spark, sf: drain(spark, getattr(windows, name)(event_stream(spark, sf), LATE, CFG), keys))


_register_window("stream_http_error_rate", ["time_bin", "service", "route"], f"SELECT {sql.T1_LIST} FROM t1")
_register_window("stream_error_signatures", ["time_bin", "service", "error_signature"], "SELECT * FROM t3")
_register_window("stream_forwarder_freshness", ["time_bin"], "SELECT * FROM t4")
_register_window("stream_forwarder_drops", ["time_bin"], "SELECT * FROM t5")
_register_window("stream_deployment_error_rate", ["time_bin", "service", "deployment_sha"],
                 f"SELECT {sql.T6_LIST} FROM t6")


@query("stream_latency_counts", sql.rollups(f"SELECT {sql.T2_LIST} FROM t2"))
def _(spark, sf):
    counts = drain(spark, windows.stream_latency_counts(event_stream(spark, sf), LATE, CFG),
                   ["time_bin", "service", "route", "duration_ms"])
    return windows.latency_from_counts(counts, CFG)


@query("stream_dedup_logs", sql.logs("""SELECT service, COUNT(*) AS log_rows FROM logs GROUP BY 1"""))
def _(spark, sf):
    # every row arrives twice, rows without an id are kept both times
    stream = event_stream(spark, sf).select("ingest_ts", "service", "insert_id")
    out = fresh_dir(spark, "stream")
    once = json_logs.dedup_logs(stream.unionByName(stream), LATE)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")

    once.writeStream.foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(
        availableNow=True).start().awaitTermination()
    rows = tables.read_table(spark, f"{out}/rows", ddl(once.dtypes) + ", batch_id bigint")
    return rows.groupBy("service").agg(F.count("*").alias("log_rows"))


# Eight days a file. Every eleventh row comes one file late; by then the watermark stands two days behind the
# newest row of its own file, and windows that ended before are closed.
PERIODS = 4
ARRIVALS = f"""arrived AS (SELECT *, (day(ingest_ts) - 1) // 8 AS period, event_id % 11 = 0 AS late FROM {{}}),
newest AS (SELECT period, MAX(ingest_ts) AS m FROM arrived WHERE NOT late GROUP BY 1),
counted AS (SELECT a.* FROM arrived a JOIN newest USING (period) WHERE NOT late
  OR time_bucket(INTERVAL '6 hours', ingest_ts) + INTERVAL '6 hours' > m - INTERVAL '2 days')"""


def arriving(spark, sf, folder: str, files) -> None:
    """Write some of the files in which the events arrive: ``period`` 0 to 4, each with the late rows of the one before."""
    df = adapters.events(spark, sf)
    period, late = F.floor((F.dayofmonth("ts") - 1) / 8), F.col("event_id") % 11 == 0
    for number in files:
        chosen = (~late & (period == number)) | (late & (period == number - 1))
        df.filter(chosen).coalesce(1).write.mode("append").parquet(folder)


def drain_files(spark, sf, streamed, keys: list[str]) -> DataFrame:
    """One file a batch; stopped after each, and started again from the checkpoint.

    Within a run Spark tests for late rows with the watermark of one batch before; between runs an
    empty batch brings it up to date.
    """
    out = fresh_dir(spark, "arrivals")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch_id={batch_id}")

    for number in range(PERIODS + 1):
        arriving(spark, sf, f"{out}/in", [number])
        events = spark.readStream.schema(adapters.EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
        stream = streamed(adapters.events_as_logs(events))
        stream.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{out}/checkpoint").trigger(
            availableNow=True).start().awaitTermination()
    rows = tables.read_table(spark, f"{out}/rows", ddl(stream.dtypes) + ", batch_id bigint")
    if not keys:
        return rows
    rest = [c for c in stream.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch_id").alias("_r")).select(*keys, "_r.*").select(*stream.columns)


@query("stream_late_requests", sql.with_(sql.LOGS, sql.VIEWS, ARRIVALS.format("http"), select=f"""
  SELECT time_bucket(INTERVAL '6 hours', ingest_ts) AS time_bin, service || '::' || route AS series_key, service, route,
  COUNT(*) AS requests, CAST(SUM({sql.BAD}) AS BIGINT) AS errors,
  round(SUM({sql.BAD}) / CAST(COUNT(*) AS DOUBLE), 6) AS error_rate FROM counted GROUP BY 1, 2, 3, 4"""))
def _(spark, sf):
    return drain_files(spark, sf, lambda rows: windows.stream_http_error_rate(rows, "2 days", CFG), ["time_bin", "service", "route"])


@query("stream_late_signatures", sql.with_(sql.LOGS, sql.VIEWS, ARRIVALS.format("errs"), select="""
  SELECT time_bucket(INTERVAL '6 hours', ingest_ts) AS time_bin, service || '::' || error_signature AS series_key, service,
  error_signature, COUNT(*) AS error_count FROM counted GROUP BY 1, 2, 3, 4"""))
def _(spark, sf):
    return drain_files(spark, sf, lambda rows: windows.stream_error_signatures(rows, "2 days", CFG),
                       ["time_bin", "service", "error_signature"])


@query("stream_dedup_files", sql.logs("SELECT service, COUNT(*) AS log_rows, COUNT(DISTINCT insert_id) AS ids FROM logs GROUP BY 1"))
def _(spark, sf):
    # each row comes again with the batch in which it arrives; what arrived late is no copy
    def twice(rows: DataFrame) -> DataFrame:
        rows = rows.select("ingest_ts", "service", "insert_id")
        return json_logs.dedup_logs(rows.unionByName(rows), "40 days")

    rows = drain_files(spark, sf, twice, [])
    return rows.groupBy("service").agg(F.count("*").alias("log_rows"), F.count_distinct("insert_id").alias("ids"))


@query("stream_refresh", sql.rollups(f"SELECT {sql.T2_LIST} FROM t2"))
def _(spark, sf):
    out = fresh_dir(spark, "follow")
    df = with_envelope(logs(spark, sf))
    late = F.col("route") == "/api/r1"
    for batch, rows in enumerate((df.filter(~late), df.filter(late))):
        tables.write_raw_logs(rows, f"{out}/raw", batch)
        refresh.stream_refresh(spark, f"{out}/raw", f"{out}/bins", f"{out}/checkpoint", CFG,
                               {"availableNow": True}).awaitTermination()
    return refresh.stored_rollups(spark, f"{out}/bins")["ts_route_latency"]


@query("run_cycle", sql.signals(ALERT_ROW))
def _(spark, sf):
    out = fresh_dir(spark, "cycle")
    store = cycle.Store(out)
    tables.write_raw_logs(with_envelope(logs(spark, sf)), store.raw_logs, 0)
    refresh.refresh_bins(spark, store.raw_logs, store.bins, refresh.touched_spans(logs(spark, sf), CFG), CFG)
    cycle.stream_cycle(spark, store, f"{out}/checkpoint", CFG, lambda: AS_OF,
                       {"availableNow": True}).awaitTermination()
    return tables.read_alert_log(spark, store.alert_log)


@query("silent_forwarders", sql.logs("""SELECT TIMESTAMP '2024-02-05 00:00:00' AS checked_at,
  MAX(ingest_ts) AS last_seen FROM fwd WHERE event_type = 'batch_sent'
  HAVING MAX(ingest_ts) < TIMESTAMP '2024-02-04 00:00:00'"""))
def _(spark, sf):
    out = fresh_dir(spark, "presence")
    presence.track_last_seen(event_stream(spark, sf), f"{out}/seen", f"{out}/checkpoint", CFG,
                             {"availableNow": True}).awaitTermination()
    return presence.silent_forwarders(spark, f"{out}/seen", AS_OF + timedelta(days=5), CFG)


@query("stream_silence", sql.logs("""SELECT service, kind, CASE kind WHEN 'silent' THEN last_seen + INTERVAL '15 minutes' ELSE ingest_ts END AS at,
  last_seen FROM (SELECT service, ingest_ts, lag(ingest_ts) OVER (PARTITION BY service ORDER BY ingest_ts) AS last_seen
    FROM fwd WHERE event_type = 'batch_sent') CROSS JOIN (VALUES ('silent'), ('heard')) kinds(kind)
  WHERE ingest_ts - last_seen > INTERVAL '15 minutes'"""))
def _(spark, sf):
    # one file a batch, started again from the checkpoint after each
    out, cfg = fresh_dir(spark, "silence"), CFG.with_(holdback=timedelta(minutes=15))
    df = adapters.events(spark, sf)
    for number in range(PERIODS):
        df.filter(F.floor((F.dayofmonth("ts") - 1) / 8) == number).coalesce(1).write.mode("append").parquet(f"{out}/in")
        events = spark.readStream.schema(adapters.EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
        silence.track_silence(adapters.events_as_logs(events), f"{out}/told", f"{out}/checkpoint", cfg,
                              {"availableNow": True}, "10 minutes").awaitTermination()
    return silence.read_silence(spark, f"{out}/told")


# ── scalar rules ────────────────────────────────────────────────────────────

@query("scalar_parsing", """SELECT event_id,
  make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS from_seconds, make_timestamp(epoch_us(ts) // 1000 * 1000)
  AS from_millis, ts AS from_micros, ts AS from_nanos, ts AS from_iso, CAST(NULL AS TIMESTAMP) AS from_junk,
  floor(value + 0.5e0) AS rounded, CAST(NULL AS DOUBLE) AS too_wide, round(value, 6) AS number,
  CAST(NULL AS DOUBLE) AS no_number, CAST(props ->> '$.k' AS INTEGER) AS from_path FROM events""")
def _(spark, sf):
    text = F.col("value").cast("string")
    forms = adapters.events(spark, sf).selectExpr(
        "*",
        "CAST(unix_seconds(ts) AS STRING) AS s",
        "CAST(unix_millis(ts) AS STRING) AS ms",
        "CAST(unix_micros(ts) AS STRING) AS us",
        "concat(CAST(unix_micros(ts) AS STRING), '999') AS ns",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'\") AS iso",
    )
    return forms.select(
        "event_id",
        parse_timestamp("s").alias("from_seconds"),
        parse_timestamp("ms").alias("from_millis"),
        parse_timestamp("us").alias("from_micros"),
        parse_timestamp("ns").alias("from_nanos"),
        parse_timestamp("iso").alias("from_iso"),
        parse_timestamp("event_type").alias("from_junk"),
        parse_number(text).alias("rounded"),
        parse_number(F.concat(F.lit("1000000"), text)).alias("too_wide"),
        parse_double(text).alias("number"),
        parse_double(F.concat(text, F.lit("d"))).alias("no_number"),
        F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("from_path"),
    )


@query("null_order", sql.logs("""SELECT coalesce(deployment_sha, 'none') AS sha, COUNT(*) AS log_rows,
  row_number() OVER (ORDER BY deployment_sha DESC NULLS FIRST) AS place_down,
  row_number() OVER (ORDER BY deployment_sha ASC NULLS LAST) AS place_up FROM logs GROUP BY deployment_sha"""))
def _(spark, sf):
    # where the dashboard's orders put rows without a value
    counted = logs(spark, sf).groupBy("deployment_sha").agg(F.count("*").alias("log_rows"))
    place = lambda order: F.row_number().over(Window.orderBy(order)).cast("bigint")
    return counted.select(
        F.coalesce("deployment_sha", F.lit("none")).alias("sha"), "log_rows",
        place(dashboard._down("deployment_sha")).alias("place_down"), place(dashboard._up("deployment_sha")).alias("place_up"),
    )


@query("uniform_integers", """SELECT 3 + (event_id * 7919) % 15 AS drawn, CAST(event_id % 4 AS BIGINT) AS kind,
  COUNT(*) AS drawn_rows FROM events GROUP BY 1, 2""")
def _(spark, sf):
    drawn = adapters.events(spark, sf).select(uniform_int(F.col("event_id"), 3, 17).alias("drawn"), F.expr("event_id % 4").alias("kind"))
    return drawn.groupBy("drawn", "kind").agg(F.count("*").alias("drawn_rows"))


@query("scalar_rules", """SELECT event_type, time_bucket(INTERVAL '5 minutes', ts) AS time_bin,
  strftime(MIN(ts), '%Y-%m-%dT%H:%M:%SZ') AS first_seen,
  round(CASE WHEN SUM(user_id % 2) = 0 THEN 0 ELSE SUM(value) / SUM(user_id % 2) END, 6) AS ratio,
  string_agg(DISTINCT CAST(user_id % 7 AS VARCHAR), ', ' ORDER BY CAST(user_id % 7 AS VARCHAR)) AS groups,
  event_type || '::' || MIN(user_id) AS series_key, CAST(MIN(user_id) AS VARCHAR) AS second_part
  FROM events GROUP BY 1, 2""")
def _(spark, sf):
    out = adapters.events(spark, sf).groupBy("event_type", time_bin("ts", 300).alias("time_bin")).agg(
        iso_z(F.min("ts")).alias("first_seen"),
        div0(F.sum("value"), F.sum(F.col("user_id") % 2)).alias("ratio"),
        distinct_list((F.col("user_id") % 7).cast("string")).alias("groups"),
        F.min("user_id").cast("string").alias("first_user"),
    ).withColumn("series_key", series_key("event_type", "first_user")).drop("first_user")
    return out.withColumn("second_part", split_part(F.col("series_key"), 2))
