"""Inputs on which operators once went wrong: ties, NULL keys, NaN, decimals, collinear columns."""

import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepanel.operators import cross_section as xs
from tidepanel.operators import dedup, increments, pit, profile, quality
from tidepanel.operators.neutralize import neutralize
from tidepanel.plans import registry
from tidepanel.sources.specs import SPECS


@pytest.mark.parametrize("q", [10, 20])
def test_both_plans_give_the_same_buckets_and_bounds(spark, q):
    rng = random.Random(q)
    rows = [(g, i, rng.lognormvariate(0, 2)) for g, n in enumerate([91, 171, 181, 331, 91, 181]) for i in range(n)]
    df = spark.createDataFrame(rows, "g int, i int, x double")
    cut = {p: sorted(map(tuple, xs.add_bucket(df, "x", ["g"], q, "b", plan=p).collect())) for p in ("window", "split")}
    assert cut["window"] == cut["split"]
    clipped = {p: sorted(map(tuple, xs.winsorize(df, ["x"], ["g"], plan=p).collect())) for p in ("window", "split")}
    assert clipped["window"] == clipped["split"]  # to the last bit


def test_null_keys_match_nothing(spark):
    left = spark.createDataFrame([("a", 5), (None, 5), (None, 6)], "k string, t int")
    right = spark.createDataFrame([("a", 1, "x"), (None, 1, "y")], "k string, t int, p string")
    for longest in (None, 1):
        found = pit.asof_join(left, right, ["k"], "t", "t", ["p"], longest=longest)
        assert sorted((r["k"] or "", r["t"], r["p"]) for r in found.collect()) == [("", 5, None), ("", 6, None), ("a", 5, "x")]


def test_intervals_with_one_start_take_the_latest_end(spark):
    facts = spark.createDataFrame([("a", 5)], "k string, t int")
    rows = [("a", 1, 9, "long"), ("a", 1, 7, "short")]
    for order in (rows, rows[::-1]):
        found = pit.interval_asof(facts, spark.createDataFrame(order, "k string, s int, e int, p string").coalesce(1), "k", "t", "s", "e", ["p"])
        assert found.first()["p"] == "long"


def test_profile_of_decimals_and_nan(spark):
    nan = float("nan")
    df = spark.createDataFrame([(Decimal("1.50"), 1.0), (Decimal("2.50"), nan), (None, None), (Decimal("0.00"), 3.0)], "d decimal(10,2), x double")
    rows = {r["column"]: r for r in profile.profile(df, "f").collect()}
    assert (rows["d"]["min"], rows["d"]["max"], rows["d"]["q50"], rows["d"]["zero_count"], rows["d"]["null_count"]) == (0.0, 2.5, 1.5, 1, 1)
    assert (rows["x"]["max"], rows["x"]["q99"], rows["x"]["nan_count"], rows["x"]["null_count"]) == (3.0, 3.0, 1, 1)
    bins = {(r["column"], r["bin"]): r["rows"] for r in profile.histogram(df).collect()}
    assert bins == {("d", 0): 1, ("d", 30): 1, ("d", 49): 1, ("x", 0): 1, ("x", 49): 1}


def test_histogram_takes_every_column(spark):
    df = spark.range(10).select(*[(F.col("id") * i).alias(f"c{i}") for i in range(1, 26)])
    assert profile.histogram(df).select("column").distinct().count() == 25


def test_collinear_sizes_leave_no_size_effect(spark):
    rng = random.Random(4)
    rows = [("d", f"s{i}", "i", (size := rng.uniform(1, 100)), size**2, 3 * np.log(size).item()) for i in range(60)]
    df = spark.createDataFrame(rows, "trade_date string, ts_code string, l1_name string, a double, b double, y double")
    kept = neutralize(df, "y", "r", sizes=("a", "b"), limits=(0.0, 1.0))
    assert kept.agg(F.max(F.abs("r"))).first()[0] < 1e-9
    flat = neutralize(df.withColumn("a", F.lit(7.0)), "y", "r", sizes=("a", "b"), limits=(0.0, 1.0))
    assert flat.agg(F.max(F.abs("r"))).first()[0] < 1e-9


def test_contract_without_any_key(spark):
    row = quality.contract_violations(spark.createDataFrame([(1,), (2,)], "z int"), SPECS["stock_daily"]).first()
    assert row["rows"] == 2 and row["null_keys"] is None and "ts_code" in row["absent_columns"]


def test_periods_compare_by_their_last_day(spark):
    rows = [("s", "level", "Q", p, 1.0) for p in ("2001Q1", "2001Q2", "2001Q3")] + [("m", "level", "M", p, v) for p, v in (("200106", None), ("200107", 1.0), ("200199", 1.0), ("200012", None))]
    rows += [("s", "change", "Q", "2001Q1", 1.0), ("s", "level", "Q", "2001Q1", 2.0)]
    found = {r["rule"]: r["violations"] for r in quality.macro_checks(spark.createDataFrame(rows, "series_id string, value_type string, frequency string, period string, value double"), "200106", "200101").collect()}
    assert found == {"bad_period": 1, "future_period": 2, "recent_null": 1, "surplus_key": 1}


def test_last_write_wins(spark):
    rows = [("t", 5, 1, "running"), ("t", 5, 2, "done"), ("u", 5, 2, "failed"), ("u", 6, 1, "done")]
    state = {r["task_key"]: r["status"] for r in increments.ledger_state(spark.createDataFrame(rows, "task_key string, updated_at int, seq int, status string"), "seq").collect()}
    assert state == {"t": "done", "u": "done"}


def test_keep_last_with_a_map(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 2, {"b": 2}), (1, 2, {"a": 9})], "k int, t int, m map<string,int>")
    assert dedup.keep_last(df, ["k"], ["t"]).first()["m"] == {"b": 2} and dedup.keep_first(df, ["k"], ["t"]).first()["m"] == {"a": 1}


def test_fingerprints_do_not_collide(spark):
    def of(rows):
        return quality.fingerprint(spark.createDataFrame(rows, "k string, a string, x double"), ["k"], "k").first()["content_hash"]

    one = of([("a|b", "c", 1.0)])
    assert one != of([("a", "b|c", 1.0)]) and one != of([("a|b", "c", 1.0000000001)])
    assert of([("k", "a", 1.0)] * 2) != of([("k", "b", 1.0)] * 2) and of([("k", None, 1.0)]) != of([("k", "", 1.0)])


def test_registries_hold_real_rows(spark):
    rows = {r["feature_name"]: r for r in registry.feature_registry(spark).collect()}
    assert len(rows) == 40 and rows["pb_rank_ind"]["unit_type"] == "rank" and rows["turnover_free"]["source_table"] == "daily_basic"
    assert rows["support_5"]["source_columns"] == "cost_5pct, close" and len({r["formula_desc"] for r in rows.values()}) == 40
    assert registry.domain_registry(spark).count() == 18
