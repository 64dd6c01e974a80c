"""JSON-lines log files: reading, extraction, de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import epoch_timestamp, iso_timestamp, parse_double, parse_number, whole_number
from ..schemas import RAW_LOGS_COLUMNS

# Input JSON paths and the log columns they fill (keys are case-sensitive).
ENVELOPE = {
    "ingest_ts": "ingestTimestamp",
    "source_ts": "sourceTimestamp",
    "service": "service",
    "environment": "environment",
    "deployment_sha": "deploymentSha",
    "severity": "severity",
    "event_type": "eventType",
    "method": "httpRequest.method",
    "route": "httpRequest.route",
    "status_code": "httpRequest.statusCode",
    "duration_ms": "httpRequest.durationMs",
    "trace_id": "traceId",
    "request_id": "requestId",
    "error_type": "error.errorType",
    "error_message": "error.message",
    "error_signature": "error.errorSignature",
    "page": "page",
    "api_status": "apiStatus",
    "source": "source",
    "insert_id": "insertId",
    "pubsub_message_id": "pubsubMessageId",
}
_CORRUPT = "_corrupt"


def _envelope_schema() -> str:
    nested: dict[str, list[str]] = {}
    for path in ENVELOPE.values():
        head, _, leaf = path.partition(".")
        nested.setdefault(head, [])
        if leaf:
            nested[head].append(f"{leaf}: string")
    parts = [f"{k} struct<{', '.join(v)}>" if v else f"{k} string" for k, v in nested.items()]
    return ", ".join(parts + [f"{_CORRUPT} string"])


def read_log_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, with the file it came from; blank lines hold no document. Takes a prefix or files."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return _lines(lines)


def stream_log_files(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.option("recursiveFileLookup", "true")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _lines(reader.text(path))


def _lines(lines: DataFrame) -> DataFrame:
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_block_start").alias("file_block"),
    ).filter(F.trim("value") != "")


def parse_lines(
    lines: DataFrame, null_if: Sequence[str] = (), keep_envelope: bool = False
) -> DataFrame:
    """Log columns plus ``is_bad`` (line is no JSON) and ``bad_values``.

    A line is parsed once against the declared envelope. Lines that do not fit
    it, such as text where an object is expected, are read once more as a variant and
    looked up path by path; that also tells broken JSON from merely unusual JSON. Each
    step is its own projection, so no conversion is evaluated twice. The lookups stand
    in a lambda, which is one call in the generated code: code of this length is not compiled by the
    JVM otherwise, but interpreted line after line.
    """
    envelope = F.from_json("value", _envelope_schema(), {"columnNameOfCorruptRecord": _CORRUPT})
    # explode() also keeps filters on the result from repeating the parse below it
    parsed = lines.withColumn("_p", F.explode(F.array(envelope)))
    parsed = parsed.withColumn("_odd", F.expr(f"_p.{_CORRUPT} IS NOT NULL OR _p IS NULL"))
    lookups = ", ".join(f"try_variant_get(j, '$.{path}', 'string') AS {name}" for name, path in ENVELOPE.items())
    parsed = parsed.withColumn("_q", F.expr(
        f"get(transform(transform(IF(_odd, array(value), array()), t -> try_parse_json(t)), j -> struct(j IS NULL AS is_bad, {lookups})), 0)"
    ))
    texts = parsed.selectExpr(
        *lines.columns,
        "_odd AND _q.is_bad AS is_bad",
        *[f"IF(_odd, _q.{name}, _p.{path}) AS _t_{name}" for name, path in ENVELOPE.items()],
    )
    if null_if:
        wanted = [
            F.when(~F.col(c).isin(list(null_if)), F.col(c)).alias(c) if c.startswith("_t_") else F.col(c)
            for c in texts.columns
        ]
        texts = texts.select(*wanted)
    numbers = texts.withColumns(
        {f"_n_{c}": whole_number(F.col(f"_t_{c}")) for c in ("ingest_ts", "source_ts")}
    )

    def moment(name: str) -> Column:
        return F.coalesce(epoch_timestamp(f"_n_{name}"), iso_timestamp(F.col(f"_t_{name}")))

    convert = {
        "ingest_ts": moment("ingest_ts"),
        "source_ts": moment("source_ts"),
        "status_code": parse_number(F.col("_t_status_code")),
        "duration_ms": parse_double(F.col("_t_duration_ms")),
    }
    typed = numbers.withColumns({f"_v_{name}": rule for name, rule in convert.items()})
    lost = " + ".join(f"CAST(_t_{c} IS NOT NULL AND _v_{c} IS NULL AS INT)" for c in convert)
    columns = {name: f"_v_{name}" if name in convert else f"_t_{name}" for name in ENVELOPE}
    columns["ingest_ts"] = "coalesce(_v_ingest_ts, current_timestamp())"
    columns["raw_envelope"] = "try_parse_json(value)" if keep_envelope else "CAST(NULL AS VARIANT)"
    return typed.selectExpr(
        *lines.columns,
        "is_bad",
        f"IF(is_bad, 0, {lost}) AS bad_values",
        *[f"{columns[name]} AS {name}" for name, _ in RAW_LOGS_COLUMNS],
    )


def extract_log_rows(
    lines: DataFrame, null_if: Sequence[str] = (), keep_envelope: bool = False
) -> DataFrame:
    """Log rows of the readable lines; unreadable numbers and times become NULL."""
    parsed = parse_lines(lines, null_if, keep_envelope)
    return parsed.filter(~F.col("is_bad")).select(*[name for name, _ in RAW_LOGS_COLUMNS])


def to_envelope(logs: DataFrame) -> DataFrame:
    """Log rows as JSON lines (the inverse of extraction), in column ``value``."""
    groups: dict[str, list[Column]] = {}
    for name, path in ENVELOPE.items():
        if name not in logs.columns:
            continue
        head, _, leaf = path.partition(".")
        kind = dict(logs.dtypes)[name]
        col = F.col(name)
        if kind.startswith("timestamp"):
            col = F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        groups.setdefault(head, []).append(col.alias(leaf or head))
    fields = [
        cols[0] if not any("." in p and p.startswith(head + ".") for p in ENVELOPE.values())
        else F.struct(*cols).alias(head)
        for head, cols in groups.items()
    ]
    return logs.select(F.to_json(F.struct(*fields)).alias("value"))


def dedup_logs(df: DataFrame, watermark: str | None = None) -> DataFrame:
    """One row per ``insert_id``; rows without an id are all kept.

    Batch: the earliest row of an id wins, chosen by an aggregation that
    combines copies before the shuffle. Stream: first arrival within the
    watermark wins.
    """
    keyed, bare = df.filter("insert_id IS NOT NULL"), df.filter("insert_id IS NULL")
    if df.isStreaming:
        if watermark is None:
            raise ValueError("a streaming de-duplication needs a watermark")
        keyed = keyed.withWatermark("ingest_ts", watermark).dropDuplicatesWithinWatermark(["insert_id"])
        return keyed.unionByName(bare.withWatermark("ingest_ts", watermark))
    rest = [c for c in df.columns if c != "insert_id"]
    first = keyed.groupBy("insert_id").agg(
        F.min_by(F.struct(*rest), F.struct("ingest_ts", "source_ts", "pubsub_message_id")).alias("_row")
    )
    first = first.select("insert_id", "_row.*").select(*df.columns)
    return first.unionByName(bare)
