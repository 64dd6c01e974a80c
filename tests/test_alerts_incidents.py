import json
from datetime import datetime, timedelta

import pytest

from beaconlog.config import SIG_DEPLOY, SIG_ERROR_RATE, SIG_LATENCY, SIG_SIGNATURE, ObsConfig
from beaconlog.operators import alerts, incidents
from beaconlog.plans import dashboard, evidence, metrics
from beaconlog.schemas import RAW_LOGS_COLUMNS, SIGNAL_COLUMNS, ddl, names
from beaconlog.sources import tables

AS_OF = datetime(2026, 1, 3)
CFG = ObsConfig()


def signals(spark, *rows):
    full = [(AS_OF - timedelta(minutes=5), t, s, r, 30, None, 0.5, 0.1, 0.05, z) for t, s, r, z in rows]
    return spark.createDataFrame(full, ddl(SIGNAL_COLUMNS))


def logs(spark, *rows):
    columns = [c for c in RAW_LOGS_COLUMNS if c[0] != "raw_envelope"]
    full = [tuple(r.get(n) for n, _ in columns) for r in rows]
    return spark.createDataFrame(full, ddl(columns))


def error(minutes=5, **changes):
    row = dict(ingest_ts=AS_OF - timedelta(minutes=minutes), service="backend", severity="ERROR", route="/a",
               event_type="http_request", status_code=500, error_signature="E:/a", deployment_sha="s1")
    return {**row, **changes}


def test_condition_and_top(spark):
    quiet = signals(spark, (SIG_LATENCY, "b", "/x", 1.4))
    assert not alerts.alert_condition(quiet) and alerts.alert_condition_row(quiet, AS_OF).first().fires is False
    assert alerts.alert_log_row(quiet, AS_OF).count() == 0
    assert alerts.alert_payload(alerts.top_signals(quiet), AS_OF).count() == 0
    many = signals(spark, *[(SIG_LATENCY, "b", f"/{i}", 2.0 + i) for i in range(14)])
    top = alerts.top_signals(many)
    assert [r.route for r in top.collect()] == [f"/{i}" for i in range(13, 3, -1)]
    assert top.first().time_bin == "2026-01-02T23:55:00Z"
    row = alerts.alert_log_row(many, AS_OF).first()
    assert (row.signal_count, row.total_count, row.top_route, row.top_score) == (10, 14, "/13", 15.0)


def test_payload_keeps_null_fields(spark):
    top = alerts.top_signals(signals(spark, (SIG_LATENCY, "b", None, 9.0), (SIG_ERROR_RATE, "b", "/y", 3.0)))
    body = json.loads(alerts.alert_payload(top, AS_OF).first().payload)
    assert list(body) == ["source", "fired_at", "signals", "top_signal"]
    assert body["fired_at"] == "2026-01-03T00:00:00Z" and len(body["signals"]) == 2
    assert body["top_signal"] == body["signals"][0] and body["top_signal"]["ANOMALY_SCORE"] == 9.0
    assert body["top_signal"]["ROUTE"] is None and body["top_signal"]["ERRORS"] is None
    assert list(body["top_signal"])[0] == "SIGNAL_TYPE" and list(body["top_signal"])[-1] == "TIME_BIN"


def test_evaluate_logs_before_payload(spark, tmp_path, monkeypatch):
    found = signals(spark, (SIG_LATENCY, "b", "/x", 9.0))
    log, out = str(tmp_path / "log"), str(tmp_path / "out")
    with monkeypatch.context() as patch:
        patch.setattr(alerts, "write_outbox", lambda *a: (_ for _ in ()).throw(OSError("unreachable")))
        with pytest.raises(OSError):
            alerts.evaluate_alerts(spark, found, AS_OF, log, out)
    assert tables.read_alert_log(spark, log).count() == 1 and tables.read_outbox(spark, out).count() == 0
    assert alerts.evaluate_alerts(spark, found, AS_OF, log, out)
    assert tables.read_alert_log(spark, log).count() == 1 and tables.read_outbox(spark, out).count() == 1
    later = AS_OF + timedelta(minutes=5)
    alerts.evaluate_alerts(spark, found, later, log, out)
    assert tables.read_alert_log(spark, log).count() == 2


def test_source_switches_both(spark):
    z, ml = signals(spark, (SIG_LATENCY, "b", "/x", 9.0)), signals(spark, ("route_latency_ml", "b", "/x", 8.0))
    assert alerts.alert_source(z, ml).first().signal_type == SIG_LATENCY
    assert alerts.alert_source(z, ml, "forecast").first().signal_type == "route_latency_ml"
    with pytest.raises(ValueError):
        alerts.alert_source(z, None, "forecast")


def test_silence_is_seen_on_empty_input(spark):
    assert alerts.alert_forwarder_silent(logs(spark), AS_OF).count() == 1
    sent = logs(spark, error(event_type="batch_sent", severity=None))
    assert alerts.alert_forwarder_silent(sent, AS_OF).count() == 0
    assert alerts.alert_forwarder_silent(sent, AS_OF + timedelta(hours=1)).count() == 1


def test_evidence_matches_the_named_field(spark):
    raw = logs(spark, error(), error(), error(deployment_sha="s2"), error(error_signature="F:/a", deployment_sha="s2"),
               error(route="/b", error_signature="E:/b"), error(minutes=50), error(service=None))
    found = signals(spark, (SIG_ERROR_RATE, "backend", "/a", 5.0), (SIG_ERROR_RATE, "backend", "/a", 6.0),
                    (SIG_SIGNATURE, "backend", "E:/b", 5.0), (SIG_DEPLOY, "backend", "s2", 5.0))
    rows = evidence.evidence_errors(found, raw, AS_OF).collect()
    got = sorted((r.signal_type, r.rank, r.error_signature, r.error_count, r.deployment_shas) for r in rows)
    assert got == [
        (SIG_ERROR_RATE, 1, "E:/a", 3, "s1, s2"), (SIG_ERROR_RATE, 2, "F:/a", 1, "s2"),
        (SIG_SIGNATURE, 1, "E:/b", 1, "s1"), (SIG_DEPLOY, 1, "E:/a", 1, "s2"), (SIG_DEPLOY, 2, "F:/a", 1, "s2")]
    assert {r.signal_type for r in evidence.evidence_errors(found, raw, AS_OF, literal=True).collect()} == {SIG_ERROR_RATE}
    assert evidence.evidence_errors(found, raw, AS_OF, limit=1).count() == 3
    shas = {r.signal_type: r.deployment_sha for r in evidence.evidence_shas(found, raw, AS_OF).collect()}
    assert shas == {SIG_ERROR_RATE: "s2", SIG_SIGNATURE: "s1", SIG_DEPLOY: "s2"}


def test_related_signals(spark):
    found = signals(spark, (SIG_ERROR_RATE, "b", "/a", 5.0), (SIG_ERROR_RATE, "b", "/a", 7.0),
                    (SIG_LATENCY, "b", "/a", 3.0), (SIG_LATENCY, "b", "/b", 3.0))
    got = sorted((r.signal_type, r.related_type, r.related_bins, r.related_max_score)
                 for r in evidence.related_signals(found).collect())
    assert got == [(SIG_ERROR_RATE, SIG_LATENCY, 1, 3.0), (SIG_LATENCY, SIG_ERROR_RATE, 2, 7.0)]


def test_candidates_and_dedup(spark):
    found = signals(spark, (SIG_ERROR_RATE, "b", "/a", 5.0), (SIG_ERROR_RATE, "b", "/a", 7.0), (SIG_LATENCY, "b", "/a", 9.0),
                    (SIG_ERROR_RATE, "b", "/low", 2.0), (SIG_DEPLOY, "b", "s9", 4.0), (SIG_SIGNATURE, "b", "E:/z", 6.0))
    shas = spark.createDataFrame([(SIG_ERROR_RATE, "b", "/a", "s1")],
                                 "signal_type string, service string, route string, deployment_sha string")
    attached = incidents.attach_deployment(found, shas)
    none_open = spark.createDataFrame([], "service string, route string, deployment_sha string")
    pick = lambda df: sorted((r.route, r.anomaly_score, r.deployment_sha) for r in df.collect())
    candidates = incidents.remediation_candidates(attached, none_open)
    assert pick(candidates) == [("/a", 5.0, "s1"), ("/a", 7.0, "s1"), ("s9", 4.0, "s9")]
    assert pick(incidents.dedup_incidents(candidates)) == [("/a", 7.0, "s1"), ("s9", 4.0, "s9")]
    known = spark.createDataFrame([("b", "/a", "s1")], none_open.schema)
    assert pick(incidents.remediation_candidates(attached, known)) == [("s9", 4.0, "s9")]
    off = CFG.with_(remediation_enabled=False)
    assert incidents.remediation_candidates(attached, none_open, off).count() == 0
    wide = CFG.with_(incident_types=CFG.incident_types + (SIG_LATENCY,))
    assert incidents.remediation_candidates(attached.fillna("s1", ["deployment_sha"]), none_open, wide).count() == 5


def test_tiles_and_null_rules(spark):
    raw = logs(spark, error(), error(severity=None, status_code=200), error(severity=None, status_code=None),
               error(service=None), error(event_type=None, service="log-forwarder"),
               error(event_type="batch_sent", service="log-forwarder"), error(minutes=90))
    rate = dashboard.tile_error_rate_by_service(raw, AS_OF).collect()
    assert [(r.service, r.total_requests, r.error_count, r.error_rate_pct) for r in rate] == [("backend", 3, 1, 33.33)]
    health = dashboard.tile_forwarder_health(raw, AS_OF).collect()
    assert [r.event_type for r in health] == ["batch_sent", None]
    top = dashboard.tile_top_error_signatures(raw, AS_OF).collect()
    assert [(r.service, r.error_count) for r in top] == [("log-forwarder", 2), ("backend", 1), (None, 1)]
    frame = dashboard.tile_recent_deployments(logs(spark, error(event_type="deployment")), AS_OF)
    assert frame.columns == ["ingest_ts", "service", "environment", "deployment_sha", "event_type"]


def test_metric_layer(spark):
    raw = logs(spark, error(duration_ms=10.0), error(duration_ms=30.0, status_code=200))
    got = metrics.metric_query(raw, "http_requests", ["error_rate", "error_count", "p95_latency_ms"], ["service"],
                               AS_OF, timedelta(hours=1)).first()
    assert (got.error_rate, got.error_count, got.p95_latency_ms) == (0.5, 2, 29.0)
    daily = metrics.metric_query(raw, "http_requests", ["request_count"], grain_seconds=86400).first()
    assert (daily.ingest_ts, daily.request_count) == (datetime(2026, 1, 2), 2)
    with pytest.raises(KeyError):
        metrics.metric_query(raw, "http_requests", ["nope"])
    with pytest.raises(KeyError):
        metrics.metric_query(raw, "deployments", [], ["route"])
    assert names(SIGNAL_COLUMNS)[0] == "time_bin"


def test_release_behind_a_signal(spark):
    at = lambda minutes: AS_OF - timedelta(minutes=minutes)
    log = "ingest_ts timestamp, source_ts timestamp, service string, environment string, event_type string, severity string, "
    log += "deployment_sha string, error_type string, error_message string, error_signature string, route string, "
    log += "trace_id string, request_id string, source string"
    deploy = lambda m, sha, env: (at(m), at(m), "s", env, "deployment", "INFO", sha) + (None,) * 7
    error = lambda m, sha: (at(m), at(m), "s", "e", "http_request", "ERROR", sha, "E", "m", "E:/r", "/r", None, None, None)
    # b is deployed again after c, which does not make it newer; d never is
    rows = [deploy(300, "a", "test"), deploy(200, "b", "prod"), deploy(100, "c", "test"), deploy(90, "c", "prod"), deploy(80, "b", "prod")]
    rows += [error(5, "c"), error(4, "c"), error(3, "b"), error(2, None)]
    logs = spark.createDataFrame(rows, log)
    signals = spark.createDataFrame(
        [("backend_http_error_rate", "s", "/r", sha) for sha in ("a", "c", "d", None)] + [("backend_http_error_rate", "s", "/other", "c")],
        "signal_type string, service string, route string, deployment_sha string",
    )
    got = {(r.route, r.deployment_sha): r for r in evidence.evidence_release(signals, logs, AS_OF).collect()}
    assert len(got) == 5
    fields = lambda r: (r.deployed_at, r.environment, r.previous_sha, r.errors, r.sha_errors, r.previous_errors)
    assert fields(got["/r", "c"]) == (at(100), "prod", "b", 4, 2, 1)
    assert fields(got["/r", "a"]) == (at(300), "test", None, 4, 0, 0)
    assert fields(got["/r", "d"]) == fields(got["/r", None]) == (None, None, None, 4, 0, 0)
    assert fields(got["/other", "c"]) == (at(100), "prod", "b", 0, 0, 0)
    empty = evidence.evidence_release(signals, logs.limit(0), AS_OF)
    assert empty.count() == 5 and empty.filter("errors > 0 OR deployed_at IS NOT NULL").count() == 0
