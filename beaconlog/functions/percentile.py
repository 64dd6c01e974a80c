"""Exact interpolated percentiles per group, one method for groups of any size.

The built-in ``percentile`` keeps every distinct value of a group in one
aggregation buffer. Here rows are first counted per group and value, which is an
ordinary two-phase aggregation and the only pass over the input. The counts are
added up per narrow value range, a running sum over a group's ranges (at most
some hundred thousand, whatever the group's size) finds the one or two that hold
the wanted ranks, and only the counts in those are put in order. Nothing runs
before the plan does, and Spark's own size checks choose the joins. The result is
the built-in's, interpolated by the same formula.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOG_STEPS = 512


def _log_range(v: Column) -> Column:
    """Non-decreasing whole-number range of ``v``, about a five hundredth wide; infinities and NaN stand alone."""
    top = F.lit(1 << 40)
    size = F.when(F.abs(v) == F.lit(float("inf")), top).otherwise(F.floor(F.log1p(F.abs(v)) * LOG_STEPS))
    return F.when(F.isnan(v), top + 1).when(v < 0, -size - 1).otherwise(size)


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left`` with the other columns of ``right`` where ``keys`` are equal or both null."""
    others = [c for c in right.columns if c not in keys]
    renamed = right.select(*[F.col(k).alias(f"_key_{n}") for n, k in enumerate(keys)], *others)
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_key_{n}")) for n, k in enumerate(keys)], F.lit(True))
    return left.join(renamed, same).select(*left.columns, *others)


def _holding(ranges: DataFrame, keys: list[str], order: str, offset: Column) -> DataFrame:
    """Rows of ``ranges`` that hold one of the two wanted ranks, with the rows before them."""
    running = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    placed = ranges.withColumn("_from", offset + F.sum("_n").over(running) - F.col("_n"))
    inside = [(F.col(k) >= F.col("_from")) & (F.col(k) < F.col("_from") + F.col("_n")) for k in ("_k0", "_k1")]
    return placed.filter(inside[0] | inside[1])


def counted_percentile(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    count: str,
    share: float,
    name: str,
    total: str = "_total",
    mean: str = "_mean",
) -> DataFrame:
    """``keys``, the percentile of ``value`` taken ``count`` times, and the number and mean of the values.

    Rows of equal values may repeat. Groups without any value are not in the result.
    """
    keys, v = list(keys), F.col("_v")
    groups = keys or ["_all"]
    own = [F.col(k) for k in keys] or [F.lit(1).alias("_all")]
    rows = counts.filter(F.col(value).isNotNull()).select(
        *own, F.col(value).cast("double").alias("_v"), F.col(count).alias("_n")
    )
    rows = rows.withColumn("_b", _log_range(v))

    whole = Window.partitionBy(*groups)
    ranges = rows.groupBy(*groups, "_b").agg(F.sum("_n").alias("_n"), F.sum(v * F.col("_n")).alias("_s"))
    ranges = ranges.withColumn(total, F.sum("_n").over(whole)).withColumn(mean, F.sum("_s").over(whole) / F.col(total))
    ranges = ranges.withColumn("_at", (F.col(total) - 1) * F.lit(share))
    ranges = ranges.withColumn("_k0", F.floor("_at")).withColumn("_k1", F.ceil("_at"))
    held = _holding(ranges, groups, "_b", F.lit(0)).withColumnRenamed("_from", "_before").drop("_n", "_s")

    step = [*groups, "_b"]
    picked = _holding(join_same(rows, held, step), step, "_v", F.col("_before"))

    def at_rank(rank: str) -> Column:
        inside = (F.col(rank) >= F.col("_from")) & (F.col(rank) < F.col("_from") + F.col("_n"))
        return F.max(F.when(inside, v))

    ends = picked.groupBy(*groups, "_at").agg(
        at_rank("_k0").alias("_v0"), at_rank("_k1").alias("_v1"), F.max(total).alias(total), F.max(mean).alias(mean)
    )
    # the built-in's formula
    between = (F.ceil("_at") - F.col("_at")) * F.col("_v0") + (F.col("_at") - F.floor("_at")) * F.col("_v1")
    result = F.when(F.col("_v0") == F.col("_v1"), F.col("_v0")).otherwise(between)
    return ends.select(*keys, result.alias(name), total, mean)


def _counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_n"))


def value_percentile(
    df: DataFrame, keys: Sequence[str], value: str, share: float, name: str, total: str, mean: str
) -> DataFrame:
    """Percentile, number and mean of the values that are not null, from one pass over ``df``."""
    return counted_percentile(_counts(df, keys, value), keys, "_v", "_n", share, name, total, mean)


def grouped_percentile(
    df: DataFrame, keys: Sequence[str], value: str, shares: dict[str, float], aggs: Sequence[Column] = ()
) -> DataFrame:
    """``keys``, the aggregates ``aggs`` and a percentile column for every name in ``shares``.

    The aggregates cost a second pass. A group without values has null percentiles;
    without keys there is always one row.
    """
    keys = list(keys)
    counts = _counts(df, keys, value)
    frames = [df.groupBy(*keys).agg(*(aggs or [F.count("*").alias("_rows")]))]
    frames += [
        counted_percentile(counts, keys, "_v", "_n", share, name).drop("_total", "_mean") for name, share in shares.items()
    ]
    columns = {c: f.schema[c].dataType for f in frames for c in f.columns if c not in keys}
    aligned = [
        f.select(*keys, *[F.col(c) if c in f.columns else F.lit(None).cast(t).alias(c) for c, t in columns.items()])
        for f in frames
    ]
    merged = reduce(DataFrame.unionByName, aligned)
    return merged.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns if c != "_rows"])
