from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from beaconlog.config import (
    SIG_DEPLOY,
    SIG_DROPS,
    SIG_ERROR_RATE,
    SIG_FRESHNESS,
    SIG_LATENCY,
    SIG_SIGNATURE,
    ObsConfig,
)
from beaconlog.operators import detect, rollups
from beaconlog.schemas import RAW_LOGS_COLUMNS, SIGNAL_COLUMNS, names
from beaconlog.sources.adapters import AS_OF, TABLE_CONFIG, logs
from beaconlog.sources.fixture import generate_log_fixture

ALIGNED = datetime(2026, 1, 3)
UNALIGNED = datetime(2026, 1, 3, 0, 2)
CFG = ObsConfig()
FRAME_DDL = (
    "time_bin timestamp, signal_type string, series_key string, service string, route string,"
    " requests bigint, errors double, value double"
)


def rows(df):
    return sorted(
        [tuple(round(v, 4) if isinstance(v, float) else v for v in r) for r in df.collect()], key=str
    )


def frame(spark, points, signal=SIG_ERROR_RATE, key="s::r", service="s", route="r", requests=100):
    """Series frame from (minutes before ALIGNED, value) points."""
    data = [
        (ALIGNED - timedelta(minutes=m), signal, key, service, route, requests, float(v), float(v))
        for m, v in points
    ]
    return spark.createDataFrame(data, FRAME_DDL)


def test_fixture_size(spark):
    got = dict(generate_log_fixture(spark, ALIGNED).groupBy("deployment_sha").count().collect())
    assert got == {"baseline-sha": 10_200, "spike-sha": 360}


@pytest.mark.parametrize(
    "as_of, count, expected",
    [
        (ALIGNED, 5, [(SIG_DEPLOY, "00:00", 9.1100), (SIG_ERROR_RATE, "23:50", 9.1100),
                      (SIG_ERROR_RATE, "23:55", 9.1100), (SIG_LATENCY, "23:50", 32.5880),
                      (SIG_LATENCY, "23:55", 31.6319)]),
        (UNALIGNED, 7, [(SIG_DEPLOY, "00:02", 8.8181), (SIG_ERROR_RATE, "00:00", 8.8181),
                        (SIG_ERROR_RATE, "23:50", 8.8181), (SIG_ERROR_RATE, "23:55", 8.8181),
                        (SIG_LATENCY, "00:00", 28.4982), (SIG_LATENCY, "23:50", 29.4078),
                        (SIG_LATENCY, "23:55", 29.6483)]),
    ],
)
def test_golden_signals(spark, as_of, count, expected):
    raw = generate_log_fixture(spark, as_of)
    got = detect.signals_from_logs(raw, as_of)
    assert got.columns == names(SIGNAL_COLUMNS)
    assert [f.dataType.simpleString() for f in got.schema] == [t for _, t in SIGNAL_COLUMNS]
    found = sorted((r.signal_type, r.time_bin.strftime("%H:%M"), round(r.anomaly_score, 4)) for r in got.collect())
    assert len(found) == count and found == sorted(expected)


def test_golden_baseline(spark):
    raw = generate_log_fixture(spark, ALIGNED)
    ts = rollups.ts_http_error_rate(raw, ALIGNED)
    base = ts.filter(F.col("time_bin") < F.lit("2026-01-02 23:45:00").cast("timestamp"))
    n, mean, sd = base.agg(F.count("*"), F.avg("error_rate"), F.stddev_samp("error_rate")).first()
    assert (n, round(mean, 6), round(sd, 6)) == (569, 0.042165, 0.068551)


def test_signals_equal_union_of_detectors(spark, sf_dir):
    raw = logs(spark, sf_dir).unionByName(
        generate_log_fixture(spark, AS_OF), allowMissingColumns=True
    )
    parts = {name: fn(raw, AS_OF, TABLE_CONFIG) for name, fn in rollups.ROLLUPS.items()}
    whole = rows(detect.signals_from_logs(raw, AS_OF, TABLE_CONFIG))
    assert whole and whole == rows(detect.recent_anomaly_signals(parts, AS_OF, TABLE_CONFIG))
    single = [
        detect.backend_http_error_rate_anomalies(parts["ts_http_error_rate"], AS_OF, TABLE_CONFIG),
        detect.route_latency_anomalies(parts["ts_route_latency"], AS_OF, TABLE_CONFIG),
        detect.error_signature_spike_anomalies(parts["ts_error_signatures"], AS_OF, TABLE_CONFIG),
        detect.forwarder_freshness_drop_anomalies(parts["ts_forwarder_freshness"], AS_OF, TABLE_CONFIG),
        detect.forwarder_drop_failure_anomalies(parts["ts_forwarder_drops"], AS_OF, TABLE_CONFIG),
        detect.post_deployment_regression_anomalies(parts["ts_deployment_error_rate"], AS_OF, TABLE_CONFIG),
    ]
    assert whole == sorted((r for d in single for r in rows(d)), key=str)


BASE = [(60, 0.1), (55, 0.2), (50, 0.1), (45, 0.2)]


def test_threshold_and_direction(spark):
    spike = frame(spark, BASE + [(10, 0.9)])
    assert detect.zscore_detect(spike, ALIGNED).count() == 1
    low = frame(spark, BASE + [(10, -0.9)])
    assert detect.zscore_detect(low, ALIGNED).count() == 0
    drop = frame(spark, [(60, 10), (55, 12), (50, 10), (45, 12), (10, 1)], signal=SIG_FRESHNESS)
    got = detect.zscore_detect(drop, ALIGNED).first()
    assert got.anomaly_score > 1.5 and got.errors == 0.0 and got.requests == 100


def test_series_without_usable_baseline_vanish(spark):
    assert detect.zscore_detect(frame(spark, [(10, 9.0)]), ALIGNED).count() == 0
    assert detect.zscore_detect(frame(spark, [(60, 0.1), (10, 9.0)]), ALIGNED).count() == 0
    assert detect.zscore_detect(frame(spark, [(60, 0.1), (50, 0.1), (10, 9.0)]), ALIGNED).count() == 0


@pytest.mark.parametrize(
    "signal, gate", [(SIG_ERROR_RATE, 20), (SIG_LATENCY, 10), (SIG_SIGNATURE, 3), (SIG_DEPLOY, 20)]
)
def test_gates(spark, signal, gate):
    for requests, hits in ((gate - 1, 0), (gate, 1)):
        got = detect.zscore_detect(frame(spark, BASE + [(10, 0.9)], signal, requests=requests), ALIGNED)
        assert got.count() == hits


def test_output_mapping(spark):
    one = lambda s: detect.zscore_detect(frame(spark, BASE + [(10, 9.0)], s), ALIGNED).first()
    assert one(SIG_SIGNATURE).requests is None and one(SIG_SIGNATURE).errors == 9.0
    assert one(SIG_DROPS).requests == 0 and one(SIG_DROPS).errors == 9.0
    assert one(SIG_LATENCY).errors is None
    deploy = one(SIG_DEPLOY)
    assert deploy.errors is None and deploy.time_bin == ALIGNED


def test_cut_compares_bin_starts(spark):
    as_of = ALIGNED + timedelta(minutes=2)
    assert detect.first_recent_bin(as_of, CFG) == datetime(2026, 1, 2, 23, 50)
    assert detect.first_recent_bin(ALIGNED, CFG) == datetime(2026, 1, 2, 23, 45)
    straddling = frame(spark, BASE + [(15, 0.9)])
    assert detect.zscore_detect(straddling, as_of).count() == 0
    assert detect.zscore_detect(straddling, ALIGNED).count() == 1


def test_colliding_keys_join_on_the_key(spark):
    a = frame(spark, BASE + [(10, 0.9)], key="a::b::c", service="a", route="b::c")
    b = frame(spark, [(60, 0.3), (50, 0.4), (45, 0.3)], key="a::b::c", service="a::b", route="c")
    assert detect.zscore_detect(a.unionByName(b), ALIGNED).count() == 2


def test_latest_sha_only_and_partial_bin(spark):
    old = frame(spark, BASE + [(10, 0.9)], SIG_DEPLOY, key="s::old", route="old")
    new = frame(spark, [(40, 0.9), (5, 0.8)], SIG_DEPLOY, key="s::new", route="new")
    both = old.unionByName(new)
    strict = detect.zscore_detect(both, ALIGNED, CFG.with_(latest_sha_only=True)).collect()
    assert [r.route for r in strict] == ["new"] and round(strict[0].baseline_mean, 3) == 0.15
    late = ALIGNED + timedelta(minutes=2)
    part = frame(spark, BASE + [(0, 0.9)])
    assert detect.zscore_detect(part, late).count() == 1
    assert detect.zscore_detect(part, late, CFG.with_(drop_partial_bin=True)).count() == 0


def test_scaling_values_keeps_scores(spark):
    raw = generate_log_fixture(spark, ALIGNED)
    scaled = raw.withColumn("duration_ms", F.col("duration_ms") * 7)
    score = lambda df: [
        round(r.anomaly_score, 6)
        for r in detect.route_latency_anomalies(rollups.ts_route_latency(df, ALIGNED), ALIGNED)
        .orderBy("time_bin").collect()
    ]
    assert score(raw) == score(scaled)


def test_trend_has_no_threshold(spark):
    raw = generate_log_fixture(spark, ALIGNED)
    trend = detect.anomaly_score_trend(rollups.ts_http_error_rate(raw, ALIGNED), ALIGNED)
    assert trend.columns == ["time_bin", "series_key", "service", "route", "requests", "z_score"]
    assert trend.filter("z_score < 0").count() >= 5 and trend.filter("z_score > 9").count() == 2


def test_replay_ignores_later_rows(spark):
    raw = generate_log_fixture(spark, ALIGNED)
    early = ALIGNED - timedelta(minutes=9)
    live = rollups.ts_http_error_rate(raw, early)
    replay = rollups.ts_http_error_rate(raw, early, CFG.with_(replay=True))
    assert live.agg(F.sum("requests")).first()[0] > replay.agg(F.sum("requests")).first()[0]
    assert replay.filter(F.col("time_bin") > F.lit(early)).count() == 0


def test_raw_log_columns(spark):
    assert generate_log_fixture(spark, ALIGNED).columns == names(RAW_LOGS_COLUMNS)


def test_merged_moments_equal_the_bins(spark):
    """Baselines from spans of any cut equal those from the bins, also far from zero."""
    import random

    rng = random.Random(2)
    start = datetime(2026, 1, 1)
    rows = [
        (start + timedelta(minutes=5 * k), kind, f"s::{key}", "s", key, 10, None, 1e6 + rng.random())
        for k in range(400) for kind in ("backend_http_error_rate", "post_deployment_regression") for key in ("/a", "/b")
        if rng.random() < 0.8
    ]
    frame = spark.createDataFrame(
        rows, "time_bin timestamp, signal_type string, series_key string, service string, route string, requests long, errors double, value double"
    )
    want = {(r.signal_type, r.base_key): (r.baseline_mean, r.baseline_stddev) for r in detect._baseline(frame).collect()}
    for span in (300, 3600, 86400):
        got = detect.merge_moments(detect.span_moments(frame, ObsConfig().with_(refresh_seconds=span))).collect()
        assert len(got) == len(want) == 3
        for r in got:
            mean, spread = want[r.signal_type, r.base_key]
            assert abs(r.baseline_mean / mean - 1) < 1e-12 and abs(r.baseline_stddev / spread - 1) < 1e-9
