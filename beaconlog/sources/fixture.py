"""Row generator for a repeatable end-to-end scenario (tests and demos).

Two days of steady traffic on one route, then ten minutes in which most
requests fail and slow down. Noise is a fixed function of the row index. Row counts,
steps and texts are fixed values: the scenario's results depend on them.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ts_lit
from ..functions import iff, uniform_int
from ..schemas import RAW_LOGS_COLUMNS


def _part(
    spark: SparkSession,
    rows: int,
    start: datetime,
    step: int,
    failing: Column,
    low: int,
    high: int,
    sha: str,
    signature: bool,
) -> DataFrame:
    i = F.col("id")
    error = "OrderValidationError"
    values = {
        "ingest_ts": F.timestamp_micros(F.unix_micros(ts_lit(start)) + i * (step * 1_000_000)),
        "service": F.lit("backend"),
        "environment": F.lit("production"),
        "deployment_sha": F.lit(sha),
        "severity": iff(failing, "ERROR", F.lit("INFO")),
        "event_type": F.lit("http_request"),
        "method": F.lit(None if signature else "GET"),
        "route": F.lit("/api/orders"),
        "status_code": iff(failing, 500, F.lit(200)),
        "duration_ms": uniform_int(i, low, high),
    }
    values["source_ts"] = values["ingest_ts"]
    if signature:
        values["error_type"] = F.lit(error)
        values["error_message"] = F.lit("Order validation failed")
        values["error_signature"] = F.lit(f"{error}:/api/orders")
    return spark.range(rows).select(
        *[values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in RAW_LOGS_COLUMNS]
    )


def generate_log_fixture(spark: SparkSession, as_of: datetime) -> DataFrame:
    i = F.col("id")
    always = F.lit(True)
    old, new = as_of - timedelta(days=2), as_of - timedelta(minutes=10)
    parts = [
        _part(spark, 10_000, old, 17, i % 50 == 0, 100, 150, "baseline-sha", False),
        _part(spark, 200, old, 864, always, 200, 300, "baseline-sha", True),
        _part(spark, 300, new, 2, i % 10 < 6, 300, 500, "spike-sha", False),
        _part(spark, 60, new, 10, always, 300, 400, "spike-sha", True),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
