"""Null, clip, flag and date rules on hand-made rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidepanel.functions import scalars as sc


def col(spark, values, expr, schema="x double"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], schema).select(expr).collect()]


def test_safe_div_needs_a_usable_denominator(spark):
    got = col(spark, [0.0, 5e-5, 1e-4, -2.0, None, math.nan, math.inf], sc.safe_div(F.lit(1.0), "x"))
    assert got == [None, None, 10000.0, -0.5, None, None, None]
    assert col(spark, [0.0], sc.safe_div(F.lit(1.0), "x", fill_value=-1.0)) == [-1.0]


def test_ratio_and_eps_div_never_raise(spark):
    assert col(spark, [0.0, 4.0, None], sc.ratio(F.lit(1.0), "x")) == [None, 0.25, None]
    assert col(spark, [0.0], sc.eps_div(F.lit(1.0), "x"))[0] == pytest.approx(1e8)


def test_clip_keeps_null_and_bounds(spark):
    assert col(spark, [-3.0, 0.5, 9.0, None], sc.clip("x", 0.0, 1.0)) == [0.0, 0.5, 1.0, None]
    assert col(spark, [-3.0, 9.0], sc.clip("x", upper=1.0)) == [-3.0, 1.0]


def test_flags_differ_on_missing(spark):
    assert col(spark, [1.0, -1.0, None], sc.flag(F.col("x") > 0)) == [1, 0, 0]
    assert col(spark, [1.0, -1.0, None], sc.flag_or_null(F.col("x") > 0)) == [1, 0, None]


def test_finite_and_lenient_cast(spark):
    assert col(spark, [1.0, math.nan, math.inf, -math.inf], sc.finite("x")) == [1.0, None, None, None]
    assert col(spark, ["1.5", "abc", None], sc.lenient_double("x"), "x string") == [1.5, None, None]


def test_logs(spark):
    assert col(spark, [0.0, -1.0, None], sc.log1p_positive("x")) == [None, None, None]
    assert col(spark, [-5.0, 0.0], sc.log1p_floor0("x")) == [0.0, 0.0]


def test_ohlc_rules(spark):
    rows = [(10.0, 11.0, 9.0, 10.5), (10.0, 10.2, 9.0, 10.5), (10.0, 11.0, 10.2, 10.5), (0.04, 11.0, 0.03, 10.0), (None, 11.0, 9.0, 10.0)]
    df = spark.createDataFrame(rows, "open double, high double, low double, close double")
    assert [r[0] for r in df.select(sc.ohlc_valid(floor=0.05)).collect()] == [True, False, False, False, False]


def test_interval_label_includes_lowest_edge(spark):
    got = col(spark, [0.0, 0.35, 0.36, 0.8, 1.0, 1.1, None], sc.interval_label("x", (0.0, 0.35, 0.80, 1.0), ("small", "mid", "big")))
    assert got == ["small", "small", "mid", "mid", "big", None, None]


def test_period_arithmetic(spark):
    df = spark.createDataFrame([("202401", "2024Q1", "20240229")], "m string, q string, d string")
    got = df.select(
        sc.shift_month("m", -1), sc.shift_month("m", 13), sc.shift_quarter("q", -1), sc.shift_quarter("q", 5), sc.compact_to_iso("d"), sc.parse_date(F.lit("2024x"))
    ).first()
    assert list(got) == ["202312", "202502", "2023Q4", "2025Q2", "2024-02-29", None]


def test_report_periods(spark):
    a, b = F.lit(dt.date(2023, 2, 1)), F.lit(dt.date(2023, 12, 31))
    got = spark.range(1).select(sc.report_periods(a, b)).first()[0]
    assert got == [dt.date(2023, 3, 31), dt.date(2023, 6, 30), dt.date(2023, 9, 30), dt.date(2023, 12, 31)]


def test_canonical_json_ignores_argument_order(spark):
    df = spark.createDataFrame([("x", 1)], "a string, b int")
    one, two = df.select(sc.canonical_json(a="a", b="b"), sc.canonical_json(b="b", a="a")).first()
    assert one == two == '{"a":"x","b":1}'


def test_shards_cover_and_repeat(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("c")).select("c", sc.shard_of("c", 4).alias("s"))
    first, second = df.collect(), df.collect()
    assert first == second and {r.s for r in first} == {0, 1, 2, 3}
