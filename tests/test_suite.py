"""Registered queries against their SQL; ``check.py`` compares all of them."""

import os

import duckdb
import pytest

from check import TABLES, canonical
from suite.registry import ORACLES, QUERIES

QUICK = [
    "extract_log_rows", "dedup_logs", "http_requests", "deployments", "ts_http_error_rate", "ts_route_latency",
    "ts_deployment_error_rate", "route_latency_large_groups", "recent_anomaly_signals", "anomaly_score_trend",
    "fit_series_model_latency", "detect_anomalies_error_rate", "tile_top_error_signatures", "metric_query_requests",
    "evidence_errors", "search_articles", "search_articles_dense", "remediation_candidates", "stream_http_error_rate",
    "group_incidents", "stream_late_signatures", "compact_tables", "evidence_release", "stream_silence",
    "scalar_parsing",
]


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in TABLES:
        if os.path.exists(f"{sf_dir}/{table}.parquet"):
            db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    got, want = QUERIES[name](spark, sf_dir).toPandas(), db.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
