import math
import struct
import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from beaconlog.functions import (
    distinct_list,
    div0,
    grouped_percentile,
    value_percentile,
    iff,
    iso_z,
    parse_double,
    parse_number,
    parse_timestamp,
    round_half_up,
    split_part,
    sql_text,
    time_bin,
    uniform_int,
)


def one(spark, column, **values):
    """Value of ``column`` over a single row of typed literals."""
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2026-01-02T23:55:00Z", datetime(2026, 1, 2, 23, 55)),
        ("2026-01-02T23:55:00+02:00", datetime(2026, 1, 2, 21, 55)),
        ("2026-01-02 23:54:59.5", datetime(2026, 1, 2, 23, 54, 59, 500000)),
        ("1720000000", datetime(2024, 7, 3, 9, 46, 40)),
        ("1720000000123", datetime(2024, 7, 3, 9, 46, 40, 123000)),
        ("1720000000123456", datetime(2024, 7, 3, 9, 46, 40, 123456)),
        ("1720000000123456789", datetime(2024, 7, 3, 9, 46, 40, 123456)),
        ("junk", None),
        ("", None),
        ("12:30:00", None),
        ("99999999999999999999999", None),
        ("-9223372036854775808", datetime(1677, 9, 21, 0, 12, 43, 145225)),
        (None, None),
    ],
)
def test_parse_timestamp(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string").select(parse_timestamp("t").alias("x"))
    got = df.select(F.date_format("x", "yyyy-MM-dd HH:mm:ss.SSSSSS")).first()[0]
    assert got == (expected and expected.strftime("%Y-%m-%d %H:%M:%S.%f"))


@pytest.mark.parametrize(
    "text, expected",
    [("500", 500), ("200.7", 201), ("200.5", 201), ("-2.5", -3), ("123456", None), ("abc", None), ("", None),
     ("99999", 99999), (None, None)],
)
def test_parse_number(spark, text, expected):
    assert one(spark, parse_number(F.col("t").cast("string")), t=text) == expected


@pytest.mark.parametrize(
    "text, expected", [("312.5", 312.5), ("1e3", 1000.0), ("", None), ("x", None), ("1.5d", None), ("2f", None)]
)
def test_parse_double(spark, text, expected):
    assert one(spark, parse_double(F.col("t")), t=text) == expected
    assert np.isnan(one(spark, parse_double(F.col("t")), t="NaN"))


@pytest.mark.parametrize("a, b, expected", [(1.0, 2.0, 0.5), (1.0, 0.0, 0.0), (1.0, None, None), (None, 0.0, None)])
def test_div0(spark, a, b, expected):
    for rule in (div0("a", "b"), div0(F.col("a"), F.col("b"))):
        df = spark.createDataFrame([(a, b)], "a double, b double")
        assert df.select(rule.alias("x")).first().x == expected


def test_small_rules(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("a",)], "x string")
    assert df.agg(distinct_list(F.col("x"))).first()[0] == "a, b"
    assert df.filter("x IS NULL").agg(distinct_list(F.col("x"))).first()[0] == ""
    assert one(spark, iff(F.lit(None).cast("boolean"), 1, F.lit(2)), z=1) == 2
    assert one(spark, round_half_up(F.col("v"), 0), v=2.5) == 3.0
    assert one(spark, round_half_up(F.col("v"), 0), v=-2.5) == -3.0
    assert one(spark, split_part(F.col("s"), 2), s="a::b::c") == "b"
    assert one(spark, iso_z(F.col("t")), t=datetime(2026, 7, 20, 14, 30)) .endswith("00Z")
    assert spark.range(1).select(F.expr(sql_text("it's a \\ b"))).first()[0] == "it's a \\ b"


def test_time_bin_equals_window(spark):
    df = spark.range(2000).select(F.timestamp_seconds(F.col("id") * 61 - 50_000).alias("ts"))
    both = df.select(time_bin("ts", 300).alias("a"), F.window("ts", "300 seconds").start.alias("b"))
    assert both.filter("a <> b").count() == 0


def test_uniform_int_range(spark):
    low, high = spark.range(1000).select(uniform_int(F.col("id"), 5, 9).alias("u")).agg(F.min("u"), F.max("u")).first()
    assert (low, high) == (5, 9)


# ── percentile ──────────────────────────────────────────────────────────────

def samples(kind):
    rng = random.Random(7)
    if kind == "skewed":
        return [rng.lognormvariate(4, 2) for _ in range(3000)]
    if kind == "equal":
        return [12.5] * 500
    if kind == "two values":
        return [1.0] * 95 + [2.0] * 5
    if kind == "signed":
        return [rng.uniform(-50, 50) for _ in range(1000)]
    if kind == "close":
        return [1000 + i * 1e-9 for i in range(900)]
    if kind == "infinite":
        return [1.0, 2.0, float("inf"), float("inf")]
    if kind == "minus infinite":
        return [float("-inf"), 1.0]
    if kind == "nan":
        return [float("nan"), 1.0, 2.0, float("inf"), float("nan"), -3.0]
    return [3.0]


def same_bits(a, b):
    return struct.pack("<d", a) == struct.pack("<d", b) or (math.isnan(a) and math.isnan(b))


KINDS = ["skewed", "equal", "two values", "signed", "close", "infinite", "single", "minus infinite", "nan"]


@pytest.mark.parametrize("kind", KINDS)
def test_percentile_is_the_built_in_bit_for_bit(spark, kind):
    values = samples(kind)
    df = spark.createDataFrame([("k", None, v) for v in values] + [("k", None, None)], "a string, b string, v double")
    shares = {"p95": 0.95, "p50": 0.5, "p0": 0.0, "p100": 1.0, "p1": 0.01}
    got = grouped_percentile(df, ["a", "b"], "v", shares, [F.count("*").alias("n")]).collect()
    want = df.agg(*[F.percentile("v", F.lit(s)).alias(n) for n, s in shares.items()]).first()
    assert len(got) == 1 and got[0].n == len(values) + 1
    for name in shares:
        assert same_bits(got[0][name], want[name]), (name, got[0][name], want[name])


def test_percentile_of_random_groups_is_the_built_in(spark):
    df = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None)
        .otherwise(F.concat(F.lit("g"), (F.col("id") % 400).cast("string"))).alias("k"),
        F.when(F.col("id") % 11 > 0, F.randn(5) * F.exp(F.randn(6) * 4)).alias("v"),
    ).cache()
    got = grouped_percentile(df, ["k"], "v", {"p": 0.95, "q": 0.3}, [F.count("*").alias("n"), F.avg("v").alias("m")]).collect()
    want = df.groupBy("k").agg(F.percentile("v", F.lit(0.95)).alias("p"), F.percentile("v", F.lit(0.3)).alias("q"),
                               F.count("*").alias("n"), F.avg("v").alias("m")).collect()
    key = lambda r: (r.k or "", r.n, r.p, r.q, round(r.m, 9))
    assert sorted(map(key, got)) == sorted(map(key, want))


def test_percentile_starts_no_job_and_reads_once(spark, tmp_path):
    spark.range(1000).selectExpr("id % 5 AS k", "CAST(id AS DOUBLE) AS v").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    spark.sparkContext.setJobGroup("planning", "percentile")
    out = value_percentile(df, ["k"], "v", 0.95, "p", "n", "m")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    spark.sparkContext.setJobGroup("after", "percentile")
    rows = {r.k: (r.n, r.p, r.m) for r in out.collect()}
    assert rows[0] == (200, pytest.approx(945.25), pytest.approx(497.5))


def test_percentile_without_keys_and_without_rows(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    assert grouped_percentile(df, [], "v", {"p": 0.95}).first().p == pytest.approx(94.05)
    empty = grouped_percentile(df.filter("v < 0"), [], "v", {"p": 0.95}, [F.count("*").alias("n")]).collect()
    assert [(r.n, r.p) for r in empty] == [(0, None)]
