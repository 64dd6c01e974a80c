"""Scalar rules as plain column expressions; all stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import ERROR_SEVERITIES

# Magnitudes at which a digits-only string stops being epoch
# seconds and is read as milliseconds, microseconds, nanoseconds.
EPOCH_MILLIS_FROM = 31_536_000_000
EPOCH_MICROS_FROM = 31_536_000_000_000
EPOCH_NANOS_FROM = 31_536_000_000_000_000

# Text worth converting at all; keeps failed conversions, which are slow, rare.
_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"(?i)^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?\s*$"
_SPECIAL = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"


def whole_number(text: Column) -> Column:
    return F.when(text.rlike(_WHOLE), text.try_cast("bigint"))


def epoch_timestamp(number: str) -> Column:
    """Timestamp from the epoch number in SQL expression ``number``, unit by magnitude."""
    def within(limit: int) -> str:
        return f"{number} > -{limit} AND {number} < {limit}"

    return F.expr(
        f"timestamp_micros(CASE WHEN {within(EPOCH_MILLIS_FROM)} THEN {number} * 1000000 "
        f"WHEN {within(EPOCH_MICROS_FROM)} THEN {number} * 1000 "
        f"WHEN {within(EPOCH_NANOS_FROM)} THEN {number} ELSE {number} div 1000 END)"
    )


def iso_timestamp(text: Column) -> Column:
    """Timestamp from text that starts with a date; NULL when unreadable."""
    dated = F.substring(F.ltrim(text), 5, 1) == "-"
    return F.when(dated, text.try_cast("timestamp"))


def parse_timestamp(column: str) -> Column:
    """Timestamp of a text column: ISO text or a digits-only epoch; NULL when unreadable."""
    number = f"IF({column} RLIKE '^[ ]*[+-]?[0-9]+[ ]*$', try_cast({column} AS BIGINT), NULL)"
    return F.coalesce(epoch_timestamp(number), iso_timestamp(F.col(column)))


def parse_number(text: Column, digits: int = 5) -> Column:
    """Whole number, rounded half away from zero; NULL if unreadable or too wide."""
    wide = F.when(text.rlike(_NUMBER), text.try_cast("decimal(38,0)"))
    return wide.try_cast(f"decimal({digits},0)").cast("int")


def parse_double(text: Column) -> Column:
    return F.when(text.rlike(_NUMBER) | text.rlike(_SPECIAL), text.try_cast("double"))


def div0(a: Column | str, b: Column | str) -> Column:
    """Division giving 0 for a zero divisor and NULL for a NULL one.

    Takes columns, or SQL text (which needs fewer calls into the JVM).
    """
    if isinstance(a, str) and isinstance(b, str):
        return F.expr(
            f"CASE WHEN ({b}) = 0 THEN IF(({a}) IS NULL, NULL, 0.0D) "
            f"ELSE CAST(({a}) AS DOUBLE) / CAST(({b}) AS DOUBLE) END"
        )
    a, b = a.cast("double"), b.cast("double")
    return F.when(b == 0, F.when(a.isNotNull(), F.lit(0.0))).otherwise(a / b)


def iff(condition: Column, yes, no) -> Column:
    """Two-way choice; a NULL condition takes the second branch."""
    yes = yes if isinstance(yes, Column) else F.lit(yes)
    return F.when(condition, yes).otherwise(no)


def is_error(status: str = "status_code", severity: str = "severity") -> Column:
    """1 for a 5xx or an error severity, else 0 (NULLs count as 0)."""
    return F.expr(
        f"CASE WHEN {status} >= 500 OR {severity} IN {sql_list(ERROR_SEVERITIES)} THEN 1 ELSE 0 END"
    )


def sql_text(value: str) -> str:
    """``value`` as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_list(values) -> str:
    return "(" + ", ".join(sql_text(v) for v in values) + ")"


def series_key(*parts: str) -> Column:
    """Columns joined by '::'; NULL when any of them is NULL."""
    return F.expr("concat(" + ", '::', ".join(parts) + ")")


def split_part(text: Column, number: int) -> Column:
    return F.split_part(text, F.lit("::"), F.lit(number))


def time_bin(column: str, seconds: int) -> Column:
    """Start of the epoch-aligned bin, in whole-number arithmetic."""
    return F.expr(f"timestamp_seconds(unix_seconds({column}) - pmod(unix_seconds({column}), {seconds}))")


def distinct_list(values: Column) -> Column:
    """Aggregate: sorted distinct values joined by ', '; '' when all are NULL."""
    return F.array_join(F.array_sort(F.collect_set(values)), ", ")


def round_half_up(value: Column, places: int) -> Column:
    return F.round(value, places)


def iso_z(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def uniform_int(key: Column, low: int, high: int, step: int = 7919) -> Column:
    """Integer in [low, high] drawn from ``key``; the same key gives the same value."""
    return F.lit(low) + F.pmod(key * step, F.lit(high - low + 1))
