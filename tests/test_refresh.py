import os
import time
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from beaconlog.config import ObsConfig
from beaconlog.operators import detect, forecast, rollups
from beaconlog.plans import cycle
from beaconlog.schemas import FIXED_ALERT_COLUMNS, INCIDENT_COLUMNS
from beaconlog.session import shared_dir
from beaconlog.sources import tables
from beaconlog.sources.fixture import generate_log_fixture
from beaconlog.streaming import presence, refresh, silence

AS_OF = datetime(2026, 1, 3)
CFG = ObsConfig()


def same(a, b):
    shape = lambda df: sorted(
        [tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()],
        key=str)
    return shape(a) == shape(b)


def test_late_rows_are_absorbed_and_signals_match(spark, tmp_path):
    raw, bins = str(tmp_path / "raw"), str(tmp_path / "bins")
    rows = generate_log_fixture(spark, AS_OF)
    late = F.col("duration_ms") % 2 == 0
    for batch, part in enumerate((rows.filter(~late), rows.filter(late))):
        tables.write_raw_logs(part, raw, batch)
        refresh.refresh_bins(spark, raw, bins, refresh.touched_spans(part, CFG), CFG)
    stored = refresh.stored_rollups(spark, bins)
    for name, rollup in rollups.ROLLUPS.items():
        assert same(stored[name], rollup(rows, None, CFG)), name
    assert same(refresh.stored_signals(spark, bins, AS_OF, CFG), detect.signals_from_logs(rows, AS_OF, CFG))

    # a repeated refresh of one span leaves the other spans alone
    before = stored["ts_http_error_rate"].count()
    refresh.refresh_bins(spark, raw, bins, [datetime(2026, 1, 2, 23)], CFG)
    assert refresh.stored_rollups(spark, bins)["ts_http_error_rate"].count() == before


def test_scan_is_pruned_to_the_days(spark, tmp_path):
    raw = str(tmp_path / "raw")
    tables.write_raw_logs(generate_log_fixture(spark, AS_OF), raw, 0)
    table = tables.read_raw_logs(spark, raw)
    assert sorted(str(r[0]) for r in table.select("ingest_date").distinct().collect()) == ["2026-01-01", "2026-01-02"]
    _, recent = detect.split_logs(table, AS_OF, CFG)
    plan = rollups.count_bins(recent, AS_OF, CFG)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan and "ingest_date" in plan.split("PushedFilters")[0]
    assert "GreaterThanOrEqual(ingest_ts" in plan


def test_stream_equals_batch(spark, tmp_path):
    raw, bins = str(tmp_path / "raw"), str(tmp_path / "bins")
    rows = generate_log_fixture(spark, AS_OF)
    for batch, part in enumerate(rows.randomSplit([1.0, 1.0], 3)):
        tables.write_raw_logs(part, raw, batch)
        refresh.stream_refresh(spark, raw, bins, str(tmp_path / "ckpt"), CFG, {"availableNow": True}).awaitTermination()
    stored = refresh.stored_rollups(spark, bins)
    assert same(stored["ts_route_latency"], rollups.ts_route_latency(rows, None, CFG))
    assert same(stored["ts_deployment_error_rate"], rollups.ts_deployment_error_rate(rows, None, CFG))


def test_cycle(spark, tmp_path):
    store = cycle.Store(str(tmp_path))
    rows = generate_log_fixture(spark, AS_OF)
    tables.write_raw_logs(rows, store.raw_logs, 0)
    refresh.refresh_bins(spark, store.raw_logs, store.bins, refresh.touched_spans(rows, CFG), CFG)
    open_now = spark.createDataFrame([], "service string, route string, deployment_sha string")
    assert cycle.run_cycle(spark, store, AS_OF, CFG, open_incidents=open_now)
    assert cycle.run_cycle(spark, store, AS_OF, CFG, open_incidents=open_now)
    log = tables.read_alert_log(spark, store.alert_log).collect()
    assert len(log) == 1 and log[0].signal_count == 5 and log[0].top_signal == "route_latency_p95"
    assert round(log[0].top_score, 4) == 32.5880
    assert tables.read_outbox(spark, store.outbox).count() == 1
    found = tables.read_cycles(spark, store.incidents, INCIDENT_COLUMNS).collect()
    # one incident for the spike, whichever of its signals is the strongest
    (row,) = found
    assert row.deployment_sha == "spike-sha" and row.signals == 2 and len(row.incident_id) == 32
    assert "Signals of this cause: 2" in row.body and "OrderValidationError:/api/orders: 60 errors" in row.body
    # a quiet clock: no signals, nothing written
    assert not cycle.run_cycle(spark, store, AS_OF + timedelta(days=1), CFG)
    assert tables.read_alert_log(spark, store.alert_log).count() == 1

    # the forecast path over the same stored bins
    cfg = CFG.with_(ml_min_history=timedelta(days=1))
    cycle.fit_models(spark, store, AS_OF, cfg)
    flagged = cycle.detect_with_models(spark, store, AS_OF, cfg)
    flagged = flagged.collect()
    assert {r.signal_type for r in flagged} == {"backend_http_error_rate_ml", "route_latency_ml"}
    again = cycle.detect_with_models(spark, store, AS_OF, cfg).count()  # replaces the first run's rows
    assert again == len(flagged)
    assert cycle.run_cycle(spark, store, AS_OF + timedelta(seconds=1), cfg, use="forecast")
    last = tables.read_alert_log(spark, store.alert_log).orderBy(F.desc("fired_at")).first()
    assert last.top_signal.endswith("_ml")


def test_presence(spark, tmp_path):
    logs, seen = str(tmp_path / "logs"), str(tmp_path / "seen")
    schema = "ingest_ts timestamp, service string, event_type string"
    assert presence.silent_forwarders(spark, seen, AS_OF).count() == 1
    row = lambda minutes, kind: [(AS_OF - timedelta(minutes=minutes), "log-forwarder", kind)]
    for data in (row(20, "batch_sent"), row(2, "message_skipped")):
        spark.createDataFrame(data, schema).write.mode("append").parquet(logs)
        presence.track_last_seen(spark.readStream.schema(schema).parquet(logs), seen, str(tmp_path / "c"),
                                 trigger={"availableNow": True}).awaitTermination()
        assert presence.silent_forwarders(spark, seen, AS_OF).count() == 1
    spark.createDataFrame(row(1, "batch_sent"), schema).write.mode("append").parquet(logs)
    presence.track_last_seen(spark.readStream.schema(schema).parquet(logs), seen, str(tmp_path / "c"),
                             trigger={"availableNow": True}).awaitTermination()
    assert presence.silent_forwarders(spark, seen, AS_OF).count() == 0


def test_a_stream_that_stops_is_noticed_without_input(spark, tmp_path):
    logs, told = str(tmp_path / "logs"), str(tmp_path / "told")
    schema = "ingest_ts timestamp, service string, event_type string"
    cfg = ObsConfig(holdback=timedelta(seconds=4))

    def send():
        now = spark.sql("SELECT current_timestamp() AS ingest_ts, 'log-forwarder' AS service, 'batch_sent' AS event_type")
        now.unionByName(now.limit(0)).write.mode("append").parquet(logs)

    def wait(wanted):
        end = time.time() + 90
        while time.time() < end:
            found = [r.kind for r in silence.read_silence(spark, told).orderBy("last_seen", F.desc("kind")).collect()]
            if found == wanted:
                return
            time.sleep(0.5)
        raise AssertionError(found)

    spark.createDataFrame([(None, "log-forwarder", "batch_sent")], schema).write.parquet(logs)
    send()
    query = silence.track_silence(spark.readStream.schema(schema).parquet(logs), told, str(tmp_path / "c"), cfg,
                                  {"processingTime": "500 milliseconds"})
    try:
        wait(["silent"])
        (row,) = silence.silent_now(spark, told).collect()
        assert row.since - row.last_seen == timedelta(seconds=4)
        send()
        wait(["silent", "heard", "silent"])
        assert silence.silent_now(spark, told).count() == 1
    finally:
        query.stop()


def test_silence_of_a_replay(spark, tmp_path):
    logs, told = str(tmp_path / "logs"), str(tmp_path / "told")
    schema = "ingest_ts timestamp, service string, event_type string"
    at = lambda minutes: AS_OF + timedelta(minutes=minutes)
    # a: a gap inside a file, one over files; b: speaks on, so that the watermark tells a's silence
    files = [[("a", 0), ("a", 5), ("a", 30), ("b", 30)], [("b", 40), ("b", 50)], [("b", 60), ("a", 60), ("a", 58)], [("b", 70)]]
    for rows in files:
        spark.createDataFrame([(at(m), s, "batch_sent") for s, m in rows], schema).coalesce(1).write.mode("append").parquet(logs)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(logs)
        silence.track_silence(stream, told, str(tmp_path / "c"), ObsConfig(), {"availableNow": True}, "1 minute").awaitTermination()
        if rows is files[1]:
            assert [r.service for r in silence.silent_now(spark, told).collect()] == ["a"]
    found = {(r.service, r.kind, r.at, r.last_seen) for r in silence.read_silence(spark, told).collect()}
    assert found == {("a", "silent", at(20), at(5)), ("a", "heard", at(30), at(5)),
                     ("a", "silent", at(45), at(30)), ("a", "heard", at(58), at(30))}
    assert silence.silent_now(spark, told).count() == 0


def test_forecast_flags_a_spike_and_needs_history(spark):
    start = AS_OF - timedelta(days=2)
    points = [(start + timedelta(minutes=5 * i), "s::r", "s", "r", 10.0 + 0.01 * i + 3 * ((i // 12) % 24) + (i * 7919 % 5))
              for i in range(576)]
    points[-1] = points[-1][:4] + (500.0,)
    ts = spark.createDataFrame(points, "time_bin timestamp, series_key string, service string, route string, p95_duration_ms double")
    train = forecast.ml_train_input(ts, "p95_duration_ms", AS_OF)
    recent = forecast.ml_detect_input(ts, "p95_duration_ms", AS_OF)
    assert train.count() == 570 and recent.count() == 6
    model = forecast.fit_series_model(train, AS_OF)
    found = forecast.run_detection("ROUTE_LATENCY_ANOMALY_MODEL", model, recent, AS_OF).collect()
    assert [r.y for r in found] == [500.0] and found[0].percentile == 1.0 and found[0].distance > 40
    assert found[0].lower_bound < found[0].forecast < found[0].upper_bound < 500
    short = train.filter(F.col("time_bin") > F.lit(AS_OF - timedelta(days=1)))
    assert forecast.fit_series_model(short, AS_OF).coef.count() == 0


def test_ml_signals_take_the_latest_run(spark):
    base = ("M", AS_OF - timedelta(minutes=5), "s::r", "s", "r", 1.0, 0.5, 0.1, 0.9, True, 1.0)
    rows = [(AS_OF - timedelta(minutes=5),) + base + (3.0, "x"), (AS_OF,) + base + (4.0, "x")]
    from beaconlog.schemas import ML_DETECTION_COLUMNS, ddl
    table = spark.createDataFrame(rows, ddl(ML_DETECTION_COLUMNS))
    assert [r.anomaly_score for r in forecast.recent_anomaly_signals_ml(table, AS_OF).collect()] == [4.0]
    assert forecast.recent_anomaly_signals_ml(table, AS_OF, dedup=False).count() == 2


def test_cycle_remembers_incidents_and_checks_fixed_limits(spark, tmp_path):
    store = cycle.Store(str(tmp_path))
    rows = generate_log_fixture(spark, AS_OF)
    tables.write_raw_logs(rows, store.raw_logs, 0)
    refresh.refresh_bins(spark, store.raw_logs, store.bins, refresh.touched_spans(rows, CFG), CFG)
    count = lambda: tables.read_cycles(spark, store.incidents, INCIDENT_COLUMNS).count()
    later = AS_OF + timedelta(seconds=30)
    assert cycle.run_cycle(spark, store, AS_OF, CFG, incidents=True)
    first = count()
    assert first == 1
    # the same again, and a later cycle: nothing new; a repeated cycle keeps its own rows
    assert cycle.run_cycle(spark, store, later, CFG, incidents=True) and count() == first
    assert cycle.run_cycle(spark, store, AS_OF, CFG, incidents=True) and count() == first

    known = cycle.remembered_incidents(spark, store, later)
    assert known.count() == 1
    cycle.close_incidents(known, store, later)
    assert cycle.run_cycle(spark, store, later + timedelta(seconds=30), CFG, incidents=True) and count() == first + 1
    fixed = tables.read_cycles(spark, store.fixed_alerts, FIXED_ALERT_COLUMNS)
    assert {r.alert for r in fixed.collect()} >= {"backend_error_rate"}
    # intermediate tables are gone
    assert not [p for p in os.listdir(shared_dir(spark) + "/beaconlog") if p.startswith(("cycle-", "fit-"))]
    # silence: no signals, but the forwarder is reported
    quiet = AS_OF + timedelta(days=3)
    assert not cycle.run_cycle(spark, store, quiet, CFG, incidents=True)
    told = tables.read_cycles(spark, store.fixed_alerts, FIXED_ALERT_COLUMNS).filter(F.col("time_bin") >= F.lit(quiet))
    assert [r.alert for r in told.collect()] == ["forwarder_silent"]


def test_source_time_window_keeps_rows_of_other_days(spark, tmp_path):
    raw = str(tmp_path / "raw")
    base = generate_log_fixture(spark, AS_OF).limit(3)
    noon = datetime(2026, 1, 2, 12)
    shifted = base.withColumn("n", F.monotonically_increasing_id() % 3).withColumn("source_ts", F.lit(noon))
    days = F.when(F.col("n") == 0, F.lit(datetime(2026, 1, 3, 1))).when(F.col("n") == 1, F.lit(datetime(2026, 1, 1, 23))).otherwise(F.lit(noon))
    tables.write_raw_logs(shifted.withColumn("ingest_ts", days).drop("n"), raw, 0)
    table, end = tables.read_raw_logs(spark, raw), noon + timedelta(hours=1)
    for cfg in (CFG, CFG.with_(replay=True)):
        assert rollups.since(table, end, timedelta(hours=2), cfg, "source_ts").count() == 3


def test_latest_sha_by_time(spark):
    at = AS_OF - timedelta(minutes=3)
    rows = [(at, "zz-old"), (at + timedelta(seconds=20), "aa-new")]
    raw = spark.createDataFrame(rows, "ingest_ts timestamp, deployment_sha string").selectExpr(
        "ingest_ts", "ingest_ts AS source_ts", "deployment_sha", "'backend' AS service", "'/a' AS route",
        "'http_request' AS event_type", "'INFO' AS severity", "200 AS status_code", "1.0D AS duration_ms", "'GET' AS method",
    )
    assert [r.deployment_sha for r in rollups.latest_shas(raw, AS_OF, CFG).collect()] == ["aa-new"]
