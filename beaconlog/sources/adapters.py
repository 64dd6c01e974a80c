"""The given tables as logs, articles and vectors.

The given ``events`` table holds no logs, so a fixed mapping turns it into log
rows, with an incident planted on the last day. Schemas are declared, so
opening a table starts no job, and ``ts`` is read as an instant so that time
filters reach the parquet scan.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ObsConfig, ts_lit

EVENTS = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EMBEDDINGS = "vec_id bigint, embedding array<float>, label int"

# The clock and windows under which the given tables are read.
AS_OF = datetime(2024, 1, 31)
INCIDENT_START = datetime(2024, 1, 30)
ARTICLES_FROM = datetime(2024, 1, 1)
TABLE_CONFIG = ObsConfig(
    bin_seconds=6 * 3600,
    refresh_seconds=86_400,
    history=timedelta(days=30),
    holdback=timedelta(days=1),
    deploy_z_threshold=1.0,
    min_requests_error_rate=5,
    min_requests_latency=5,
    ml_holdback=timedelta(days=2),
    ml_keep=timedelta(days=1),
    ml_phase_seconds=6 * 3600,
    ml_interval=0.95,
    tile_window=timedelta(days=30),
    tile_rate_window=timedelta(days=30),
    tile_deploy_window=timedelta(days=30),
    tile_sha_window=timedelta(days=30),
    evidence_window=timedelta(days=1),
    alert_error_rate=0.05,
    alert_p95_ms=500.0,
    incident_min_score=2.0,
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


# The mapping from events to log columns. ``incident`` and
# ``fails`` are computed first. The variant envelope is left out.
_INCIDENT = f"ts >= TIMESTAMP '{INCIDENT_START:%Y-%m-%d %H:%M:%S}+00:00'"
_FAILS = "event_type = 'error' OR (incident AND event_type = 'click' AND user_id % 2 = 0)"
_ROUTE = "concat('/api/r', CAST(user_id % 2 AS STRING))"
_LOG_COLUMNS = {
    "ingest_ts": "ts",
    "source_ts": "ts",
    "service": "CASE event_type WHEN 'signup' THEN 'log-forwarder' WHEN 'view' THEN 'web-frontend' ELSE 'backend' END",
    "environment": "'production'",
    "deployment_sha": "CASE WHEN incident THEN 'sha-new' ELSE concat('sha-', CAST(user_id % 3 AS STRING)) END",
    "severity": "CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN 'CRITICAL' WHEN fails THEN 'ERROR' ELSE 'INFO' END",
    "event_type": """CASE WHEN event_type = 'signup' AND (user_id % 5 = 0 OR (incident AND user_id % 5 < 4))
        THEN 'message_skipped' WHEN event_type = 'signup' THEN 'batch_sent'
        WHEN event_type = 'purchase' AND event_id % 20 = 0 THEN 'deployment' ELSE 'http_request' END""",
    "method": "CASE event_type WHEN 'signup' THEN NULL WHEN 'purchase' THEN 'POST' ELSE 'GET' END",
    "route": _ROUTE,
    "status_code": "CASE WHEN event_type = 'signup' THEN NULL WHEN fails THEN 500 ELSE 200 END",
    "duration_ms": "CASE WHEN event_type <> 'signup' THEN value * IF(incident AND user_id % 2 = 0, 30.0D, 10.0D) END",
    "trace_id": "concat('t', CAST(event_id AS STRING))",
    "request_id": "concat('q', CAST(event_id AS STRING))",
    "error_type": "CASE WHEN fails THEN 'E' END",
    "error_message": f"CASE WHEN fails THEN concat('failed on ', {_ROUTE}) END",
    "error_signature": f"CASE WHEN fails THEN concat('E:', {_ROUTE}) END",
    "page": "CASE WHEN event_type = 'view' THEN concat('/page/', CAST(user_id % 4 AS STRING)) END",
    "api_status": "CASE WHEN event_type = 'view' THEN 'ok' END",
    "source": "'events'",
    "insert_id": "concat('i', CAST(event_id AS STRING))",
    "pubsub_message_id": "concat('m', CAST(event_id AS STRING))",
}


def events_as_logs(df: DataFrame) -> DataFrame:
    """The given events as raw log rows (all columns but the variant envelope)."""
    marked = df.selectExpr("*", f"{_INCIDENT} AS incident").selectExpr("*", f"{_FAILS} AS fails")
    return marked.selectExpr(*[f"{rule} AS {name}" for name, rule in _LOG_COLUMNS.items()])


def logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_logs(events(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


# what an article is about, so that searches for signals find some
_SUBJECTS = ["remediation steps", "root cause", "similar incidents", "failure", "deployment"]


def documents_as_articles(df: DataFrame) -> DataFrame:
    """Documents as articles; the body begins with the category and a subject."""
    number = F.col("doc_id")
    subject = F.element_at(F.array(*[F.lit(s) for s in _SUBJECTS]), (number % len(_SUBJECTS) + 1).cast("int"))
    category = (
        F.when(number % 4 == 0, "postmortem")
        .when(number % 4 == 1, "runbook")
        .when(number % 4 == 2, "architecture")
        .otherwise("faq")
    )
    written = F.timestamp_seconds(F.unix_seconds(ts_lit(ARTICLES_FROM)) + number * 60)
    return df.select(
        number.cast("string").alias("article_id"),
        F.substring("text", 1, 60).alias("title"),
        category.alias("category"),
        F.col("source").alias("service"),
        F.array("lang", "source").alias("tags"),
        F.concat(category, F.lit(" "), subject, F.lit("\n"), F.col("text")).alias("body"),
        written.alias("authored_at"),
        written.alias("updated_at"),
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_as_articles(documents(spark, sf_dir))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EMBEDDINGS).parquet(f"{sf_dir}/embeddings.parquet")
