"""Helpers shared by the operators: stored intermediates, prefix sums, row keys."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import fresh_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character untouched; pure ASCII takes the fast way."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def store(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back.

    A lost executor then costs at most the tasks of one step, and columns that
    depend on how rows lay in partitions are fixed once and for all.
    """
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_base(parts: DataFrame, key: str, size: str, base: str, chunk: int = 4096) -> DataFrame:
    """Adds ``base``: the sum of ``size`` over all smaller keys.

    ``parts`` has one row per non-negative whole key. Sums are built in two
    levels, so a single task meets one row per ``chunk`` keys, never all.
    """
    grouped = parts.withColumn("_chunk", F.floor(F.col(key) / chunk))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = grouped.groupBy("_chunk").agg(F.sum(size).alias("_sum"))
    tops = tops.select("_chunk", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_above"))
    inside = Window.partitionBy("_chunk").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (
        grouped.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .join(tops, "_chunk")
        .withColumn(base, F.col("_above") + F.col("_inside"))
        .drop("_chunk", "_above", "_inside")
    )


def free_names(df: DataFrame, *names: str) -> list[str]:
    """``names`` with as many underscores in front as it takes not to meet a column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def text_key(text: str = "text") -> Column:
    """128 bits of the text; with the id it names a row, and equal rows alike."""
    value = F.coalesce(F.col(text), F.lit(""))
    return F.substring(F.sha2(value, 256), 1, 32)


def worker_memo(owner: str) -> dict:
    """A dictionary that lives as long as the Python worker, across tasks, until another owner asks for one.

    A worker serves one step after another, so it holds what one of them remembers, not all.
    """
    home = sys.modules.setdefault("_llm_worker_memo", types.ModuleType("_llm_worker_memo")).__dict__
    if home.get("owner") != owner:
        home["owner"], home["memo"] = owner, {}
    return home["memo"]
