import json
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from beaconlog.config import utc_now
from beaconlog.schemas import RAW_LOGS_COLUMNS, names
from beaconlog.sources import json_logs, snapshots, tables
from beaconlog.streaming import ingest

GOOD = {
    "ingestTimestamp": "2026-01-02T23:55:00Z", "sourceTimestamp": "2026-01-02T23:54:59.5Z", "service": "backend",
    "environment": "production", "deploymentSha": "abc", "severity": "ERROR", "eventType": "http_request",
    "httpRequest": {"method": "GET", "route": "/api/orders", "statusCode": "500", "durationMs": "312.5"},
    "traceId": "t1", "requestId": "r1",
    "error": {"errorType": "OrderValidationError", "message": "Order validation failed",
              "errorSignature": "OrderValidationError:/api/orders"},
    "insertId": "i1", "pubsubMessageId": "m1",
}


def line(**changes):
    body = {**GOOD, **changes}
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def parse(spark, *lines, **options):
    return json_logs.parse_lines(spark.createDataFrame([(x,) for x in lines], "value string"), **options)


def http(**changes):
    return {"httpRequest": {**GOOD["httpRequest"], **changes}}


def test_good_line(spark):
    row = parse(spark, line()).first()
    assert not row.is_bad and row.bad_values == 0
    assert row.ingest_ts == datetime(2026, 1, 2, 23, 55) and row.source_ts.microsecond == 500000
    assert (row.status_code, row.duration_ms, row.method, row.route) == (500, 312.5, "GET", "/api/orders")
    assert row.error_signature == "OrderValidationError:/api/orders" and row.page is None and row.raw_envelope is None


@pytest.mark.parametrize("value, expected, bad", [
    ("abc", None, 1), ("200.7", 201, 0), ("123456", None, 1), (500, 500, 0), (500.0, 500, 0), (None, None, 0)])
def test_status_codes(spark, value, expected, bad):
    row = parse(spark, line(**http(statusCode=value))).first()
    assert (row.status_code, row.bad_values) == (expected, bad)


def test_times_fall_back_to_load_time(spark):
    now = utc_now()
    rows = parse(spark, line(ingestTimestamp=...), line(ingestTimestamp="junk", sourceTimestamp="junk")).collect()
    assert all(abs(r.ingest_ts - now) < timedelta(minutes=10) for r in rows)
    assert rows[0].bad_values == 0 and rows[1].bad_values == 2 and rows[1].source_ts is None


def test_unusual_documents(spark):
    rows = parse(
        spark,
        line(**http(durationMs="")),
        '{"Service":"x"}',
        line(service={"a": 1}),
        line(httpRequest="text", service=1.5),
        line(httpRequest=None),
        "[1,2]",
        "123",
    ).collect()
    assert [r.is_bad for r in rows] == [False] * 7
    assert rows[0].duration_ms is None and rows[0].bad_values == 1
    assert rows[1].service is None
    assert json.loads(rows[2].service) == {"a": 1}
    assert rows[3].service == "1.5" and rows[3].route is None and rows[3].insert_id == "i1"
    assert rows[4].route is None and rows[4].insert_id == "i1"
    assert rows[5].service is None and rows[6].service is None


def test_generated_code_is_compiled(spark, place):
    """The JVM leaves methods above 8,000 bytes of code to its interpreter, which costs more than the parsing itself."""
    folder, _ = place
    (folder / "a.jsonl").write_text(line() + "\n")
    plan = json_logs.parse_lines(json_logs.read_log_files(spark, str(folder)))._jdf.queryExecution().executedPlan()
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(plan))]
    assert sizes and max(sizes) < 8000


def test_options(spark):
    row = parse(spark, line(page="null", source=""), null_if=("NULL", "null", ""), keep_envelope=True).first()
    assert row.page is None and row.source is None
    kept = parse(spark, line(), keep_envelope=True)
    assert kept.select(F.expr("variant_get(raw_envelope, '$.error.errorType', 'string')")).first()[0] == "OrderValidationError"
    assert parse(spark, line(page="")).first().page == ""


def test_round_trip_through_envelope(spark):
    rows = parse(spark, line(), line(page="/x", insertId="i2")).drop("is_bad", "bad_values", "value", "raw_envelope")
    again = parse(spark, *[r.value for r in json_logs.to_envelope(rows).collect()])
    assert sorted(rows.collect(), key=str) == sorted(again.select(*rows.columns).collect(), key=str)


@pytest.fixture
def place(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return folder, str(tmp_path)


def poll(spark, place, **options):
    folder, base = place
    ingest.ingest_available(spark, str(folder), f"{base}/raw", f"{base}/history", f"{base}/ckpt", **options)
    return tables.read_raw_logs(spark, f"{base}/raw"), tables.read_load_history(spark, f"{base}/history")


def test_each_file_once_and_history(spark, place):
    folder, _ = place
    (folder / "a.jsonl").write_text(line() + "\n\n" + line(insertId="i2") + "\nnot json\n")
    (folder / "b.jsonl").write_text("broken\nalso broken\n{a third\n")
    (folder / "empty.jsonl").write_text("")
    raw, history = poll(spark, place)
    assert raw.count() == 2 and raw.columns == names(RAW_LOGS_COLUMNS) + ["ingest_date"]
    raw, history = poll(spark, place)
    assert raw.count() == 2
    (folder / "c.jsonl").write_text(line(insertId="i3", **http(statusCode="123456")) + "\n")
    raw, history = poll(spark, place)
    assert sorted(r.insert_id for r in raw.collect()) == ["i1", "i2", "i3"]
    got = {r.file_name.rsplit("/", 1)[1]: (r.status, r.row_count, r.error_count, r.bad_values) for r in history.collect()}
    assert got == {"a.jsonl": ("Partially loaded", 2, 1, 0), "b.jsonl": ("Load failed", 0, 3, 0),
                   "c.jsonl": ("Loaded", 1, 0, 1)}
    errors = ingest.recent_load_errors(history, utc_now()).collect()
    assert [r.file_name.rsplit("/", 1)[1] for r in errors] == ["b.jsonl"]
    assert errors[0].first_error_message == "Error parsing JSON: broken"
    assert ingest.recent_load_errors(history, utc_now() + timedelta(hours=25)).count() == 0


def test_skipping_bad_files(spark, place):
    folder, _ = place
    (folder / "a.jsonl").write_text(line() + "\nnot json\n")
    (folder / "b.jsonl").write_text(line(insertId="i2") + "\n")
    raw, history = poll(spark, place, skip_bad_files=True)
    assert [r.insert_id for r in raw.collect()] == ["i2"]
    assert {r.status: r.row_count for r in history.collect()} == {"Load failed": 0, "Loaded": 1}


def test_repeated_batch_replaces_itself(spark, place):
    _, base = place
    lines = spark.createDataFrame([(line(), "f"), (line(insertId="i2"), "f")], "value string, file_name string")
    for _ in range(2):
        ingest.load_batch(json_logs.parse_lines(lines), f"{base}/raw", f"{base}/history", 7)
    assert tables.read_raw_logs(spark, f"{base}/raw").count() == 2
    assert tables.read_load_history(spark, f"{base}/history").count() == 1
    assert tables.read_raw_batch(spark, f"{base}/raw", 7).count() == 2


def test_batch_keeps_no_whole_lines(spark, place, monkeypatch):
    folder, _ = place
    (folder / "a.jsonl").write_text(line() + "\n" + "b" * 5000 + "\n")
    seen, record = [], ingest.load_record

    def watched(parsed, *args):
        seen.append((parsed.columns, sorted((r.is_bad, r.value) for r in parsed.collect())))
        return record(parsed, *args)

    monkeypatch.setattr(ingest, "load_record", watched)
    raw, history = poll(spark, place)
    (columns, rows), = seen
    assert rows == [(False, None), (True, "b" * 200)] and "file_time" not in columns
    assert raw.count() == 1 and history.first().first_error_message == "Error parsing JSON: " + "b" * 200


def test_rescan_loads_only_unknown_files(spark, place):
    folder, base = place
    (folder / "old.jsonl").write_text(line() + "\n")
    raw, _ = poll(spark, place, refresh=False, started_at=utc_now() + timedelta(days=1))
    assert raw.count() == 0
    args = (spark, str(folder), f"{base}/raw", f"{base}/history")
    assert ingest.refresh_files(*args, run_id=-1) == 1
    assert ingest.refresh_files(*args, run_id=-2) == 0
    assert tables.read_raw_logs(spark, f"{base}/raw").count() == 1


def test_rescan_opens_only_new_files(spark, place, monkeypatch):
    folder, base = place
    asked, read = [], ingest.read_log_files
    monkeypatch.setattr(ingest, "read_log_files", lambda spark, paths: asked.append(sorted(paths)) or read(spark, paths))
    args = (spark, str(folder), f"{base}/raw", f"{base}/history")
    (folder / "a b[1].jsonl").write_text(line() + "\nfirst bad\n" + "second bad\n" * 50)
    assert ingest.refresh_files(*args, run_id=-1) == 1
    (folder / "c.jsonl").write_text(line(insertId="i2") + "\n")
    (folder / "empty.jsonl").write_text("")
    assert ingest.refresh_files(*args, run_id=-2) == 1
    # nothing is new: what the batch holds stays
    assert ingest.refresh_files(*args, run_id=-2) == 0
    assert sorted(r.insert_id for r in tables.read_raw_logs(spark, f"{base}/raw").collect()) == ["i1", "i2"]
    history = {r.row_count: r for r in tables.read_load_history(spark, f"{base}/history").collect() if r.error_count}
    assert history[1].error_count == 51 and history[1].first_error_message.endswith("first bad")
    assert [[p.rsplit("/", 1)[1].replace("\\", "") for p in paths] for paths in asked] == [["a b[1].jsonl"], ["c.jsonl"]]


@pytest.mark.parametrize("failing", [1, 2])
def test_rescan_survives_a_failing_writer(spark, place, monkeypatch, failing):
    """No file counts as loaded without its rows, whichever write or the commit fails."""
    folder, base = place
    for k in range(6):
        (folder / f"{k}.jsonl").write_text(line(insertId=f"i{k}") + "\n")
    args, calls, stage = (spark, str(folder), f"{base}/raw", f"{base}/history"), [], snapshots._stage

    def broken(*a):
        calls.append(a)
        if len(calls) == failing:
            raise OSError("disk gone")
        return stage(*a)

    monkeypatch.setattr(snapshots, "_stage", broken)
    with pytest.raises(OSError):
        ingest.refresh_files(*args, run_id=-1, group_files=2)
    assert tables.read_load_history(spark, f"{base}/history").count() == tables.read_raw_logs(spark, f"{base}/raw").count() == 0
    monkeypatch.setattr(snapshots, "_stage", stage)
    assert ingest.refresh_files(*args, run_id=-1, group_files=2) == 6
    assert ingest.refresh_files(*args, run_id=-1, group_files=2) == 0
    assert sorted(r.insert_id for r in tables.read_raw_logs(spark, f"{base}/raw").collect()) == [f"i{k}" for k in range(6)]


def test_dedup_keeps_rows_without_id(spark):
    rows = json_logs.extract_log_rows(
        spark.createDataFrame(
            [(line(),), (line(ingestTimestamp="2026-01-02T23:50:00Z", page="first"),), (line(insertId=None),),
             (line(insertId=None),), (line(insertId="i2"),)], "value string"))
    out = json_logs.dedup_logs(rows).collect()
    assert sorted(str(r.insert_id) for r in out) == ["None", "None", "i1", "i2"]
    assert [r.page for r in out if r.insert_id == "i1"] == ["first"]
