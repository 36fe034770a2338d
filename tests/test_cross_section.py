"""Both plans of every cross-section operator against pandas and NumPy."""

import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from suite.rounding import rounded
from tidepanel.functions import timeseries as ts
from tidepanel.operators import cross_section as xs
from tidepanel.operators import evaluate as ev
from tidepanel.operators.neutralize import neutralize
from tidepanel.operators.ordered import exact_quantiles, running_total
from tidepanel.plans import factors


@pytest.fixture(scope="module")
def panel():
    rng = np.random.default_rng(7)
    rows = []
    for d, n in (("d1", 300), ("d2", 45), ("d3", 3)):  # one date holds most of the rows
        for i in range(n):
            x = float(rng.integers(0, 12)) if i % 3 else 5.0  # a third of the rows share one value
            rows.append((d, f"c{i:04d}", None if i % 11 == 0 else x, float(rng.normal()), float(np.exp(rng.normal())), "abcd"[int(rng.integers(0, 4))]))
    return pd.DataFrame(rows, columns=["trade_date", "ts_code", "x", "y", "size", "ind"])


@pytest.fixture(scope="module")
def df(spark, panel):
    p = panel.astype(object).where(panel.notna(), None)
    return spark.createDataFrame(p.values.tolist(), "trade_date string, ts_code string, x double, y double, size double, ind string").repartition(3)


PLANS = ["window", "split"]


def fetch(df, *cols):
    return df.select("trade_date", "ts_code", *cols).toPandas().sort_values(["trade_date", "ts_code"]).reset_index(drop=True)


@pytest.mark.parametrize("plan", PLANS)
def test_average_rank_is_pandas_pct_rank(df, panel, plan):
    got = fetch(xs.add_ranks(df, {"r": "x"}, ["trade_date"], ["ts_code"], "ts_code", method="average", plan=plan), "r")
    want = panel.sort_values(["trade_date", "ts_code"]).groupby("trade_date")["x"].rank(pct=True).to_numpy()
    np.testing.assert_allclose(got["r"].astype(float), want, atol=1e-12)


@pytest.mark.parametrize("plan", PLANS)
def test_ordinal_rank_breaks_ties_by_code(df, panel, plan):
    got = fetch(xs.add_ranks(df, {"up": "x", "down": "x"}, ["trade_date"], ["ts_code"], "ts_code", descending=["down"], min_n=5, plan=plan), "up", "down")
    p = panel.sort_values(["trade_date", "ts_code"])
    n = p.groupby("trade_date")["x"].transform("count")
    up = (p.groupby("trade_date")["x"].rank(method="first") / n).where(n >= 5)
    down = ((-p["x"]).groupby(p["trade_date"]).rank(method="first") / n).where(n >= 5)
    np.testing.assert_allclose(got["up"].astype(float), up, atol=1e-12)
    np.testing.assert_allclose(got["down"].astype(float), down, atol=1e-12)


def test_known_average_ranks(spark):
    df = spark.createDataFrame([(1, 3.0), (2, 1.0), (3, 3.0), (4, None), (5, 2.0)], "ts_code int, x double").withColumn("d", F.lit(1))
    for plan in PLANS:
        out = xs.add_ranks(df, {"r": "x"}, ["d"], ["ts_code"], "ts_code", method="average", plan=plan).orderBy("ts_code")
        assert [r.r for r in out.collect()] == [0.875, 0.25, 0.875, None, 0.5]


@pytest.mark.parametrize("plan", PLANS)
@pytest.mark.parametrize("q", [3, 5])
def test_buckets_follow_qcut(df, panel, plan, q):
    got = fetch(xs.add_bucket(df, "x", ["trade_date"], q, "b", plan=plan), "b")["b"].astype(float)
    p = panel.sort_values(["trade_date", "ts_code"])
    want = p.groupby("trade_date")["x"].transform(lambda s: pd.qcut(s, q, labels=False, duplicates="drop") + 1)
    np.testing.assert_array_equal(got, want.to_numpy())


@pytest.mark.parametrize("plan", PLANS)
def test_winsorize_uses_linear_quantiles(df, panel, plan):
    got = fetch(xs.winsorize(df, ["y"], ["trade_date"], plan=plan), "y")["y"]
    p = panel.sort_values(["trade_date", "ts_code"])
    want = p.groupby("trade_date")["y"].transform(lambda s: s.clip(s.quantile(0.02), s.quantile(0.98)))
    np.testing.assert_allclose(got, want, atol=1e-12)


def test_constant_group_is_only_centred(spark):
    df = spark.createDataFrame([("d", 1, 4.0), ("d", 2, 4.0), ("e", 1, 1.0)], "trade_date string, ts_code int, x double")
    assert {r.x for r in xs.standardize(df, ["x"], ["trade_date"]).collect()} == {0.0}


def test_quantiles_and_running_totals(df, panel):
    got = exact_quantiles(df, ["trade_date"], "y", {"a": 0.1, "b": 0.5}, parts=6).toPandas().set_index("trade_date").sort_index()
    want = panel.groupby("trade_date")["y"].quantile([0.1, 0.5]).unstack()
    np.testing.assert_allclose(got.to_numpy(), want.to_numpy(), atol=1e-12)
    near = exact_quantiles(df, ["trade_date"], "x", {"a": 0.3}, interpolation="nearest").toPandas().set_index("trade_date")["a"]
    for d, s in panel.dropna().groupby("trade_date")["x"]:
        assert near[d] == sorted(s)[int(0.3 * (len(s) - 1) + 0.5)]
    pos = running_total(df.select("trade_date", "ts_code"), ["trade_date"], ["ts_code"], parts=7).toPandas()
    for _, g in pos.groupby("trade_date"):
        assert list(g.sort_values("ts_code")["pos"]) == list(range(len(g)))


def residuals(day: pd.DataFrame) -> pd.Series:
    ok = day["x"].notna() & day["ind"].notna() & (day["size"] > 0)
    out = pd.Series(np.nan, index=day.index)
    if ok.sum() < 30:
        return out
    v = day[ok]
    y = v["x"].clip(v["x"].quantile(0.02), v["x"].quantile(0.98)).to_numpy()
    s = np.log(v["size"])
    s = s.clip(s.quantile(0.02), s.quantile(0.98)).to_numpy()
    design = np.column_stack([np.ones(len(v)), s, pd.get_dummies(v["ind"], drop_first=True).to_numpy(dtype=float)])
    beta, *_ = np.linalg.lstsq(design, y, rcond=None)
    out[ok] = y - design @ beta
    return out


@pytest.mark.parametrize("plan", PLANS)
def test_neutralize_matches_least_squares(df, panel, plan):
    got = fetch(neutralize(df, "x", "res", industry="ind", sizes=["size"], plan=plan), "res")["res"].astype(float)
    p = panel.sort_values(["trade_date", "ts_code"])
    want = pd.concat([residuals(g) for _, g in p.groupby("trade_date")]).sort_index()
    np.testing.assert_allclose(got, want.reindex(p.index).to_numpy(), atol=1e-9)


def test_neutralize_with_constant_size_is_demeaning(spark):
    rows = [("d", i, float(i), 1.0, "ab"[i % 2]) for i in range(40)]
    df = spark.createDataFrame(rows, "trade_date string, ts_code int, x double, size double, ind string")
    a = neutralize(df, "x", "r", industry="ind", sizes=["size"], plan="window").orderBy("ts_code").toPandas()["r"]
    b = neutralize(df, "x", "r", industry="ind", sizes=[], plan="window").orderBy("ts_code").toPandas()["r"]
    np.testing.assert_allclose(a, b, atol=1e-12)
    sums = a.groupby(np.arange(40) % 2).sum()
    np.testing.assert_allclose(sums, 0, atol=1e-9)


def test_sigma_quantile_and_mad_clips(df, panel):
    out = xs.clip_mad(xs.clip_quantile(xs.clip_sigma(df, {"s": "y"}, 1.0), {"q": "y"}), {"m": "y"}, 1.0)
    got = fetch(out, "s", "q", "m")
    y = panel.sort_values(["trade_date", "ts_code"])["y"].reset_index(drop=True)
    med = y.median()
    mad = (y - med).abs().median()
    np.testing.assert_allclose(got["s"], y.clip(y.mean() - y.std(), y.mean() + y.std()), atol=1e-12)
    np.testing.assert_allclose(got["q"], y.clip(y.quantile(0.01), y.quantile(0.99)), atol=1e-12)
    np.testing.assert_allclose(got["m"], y.clip(med - mad, med + mad), atol=1e-12)


def test_plan_choice_follows_group_width(df):
    assert xs.choose_plan(df, ["trade_date"]) == "window"
    assert xs.choose_plan(df, ["trade_date"], width=xs.WINDOW_ROW_LIMIT + 1) == "split"


def test_information_coefficients(df, panel):
    got = ev.information_coefficients(df.withColumnRenamed("y", "ret"), "x", ["trade_date"]).toPandas().set_index("trade_date")
    for d, g in panel.dropna().groupby("trade_date"):
        if g["x"].nunique() > 1:
            assert got.loc[d, "ic"] == pytest.approx(g["x"].corr(g["y"]))
            assert got.loc[d, "rank_ic"] == pytest.approx(g["x"].rank().corr(g["y"].rank()))


def test_time_series_expressions(spark):
    x = [1.0, None, 3.0, 3.0, 8.0, None, None, 2.0]
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(x)], "ts_code string, t int, x double")
    w = ts.entity_window(time="t")
    got = df.select("t", ts.forward_fill("x", w, 1).alias("f"), ts.backward_fill("x", w, 1).alias("b"), ts.rolling_mean("x", 3, w, 2).alias("m"), ts.zscore("x", 2, w).alias("z"),
                    ts.cumulative_growth(F.col("x") / 10, w).alias("g"), ts.cumulative_growth(F.when(F.col("t") == 2, -1.0).otherwise(0.5), w).alias("ruin")).toPandas().sort_values("t")
    s = pd.Series(x)
    np.testing.assert_allclose(got["f"].astype(float), s.ffill(limit=1))
    np.testing.assert_allclose(got["b"].astype(float), s.bfill(limit=1))
    np.testing.assert_allclose(got["m"].astype(float), s.rolling(3, min_periods=2).mean())
    z = (s - s.rolling(2).mean()) / s.rolling(2).std()
    np.testing.assert_allclose(got["z"].astype(float), z.replace([np.inf, -np.inf], np.nan))
    np.testing.assert_allclose(got["g"], (1 + s.fillna(0) / 10).cumprod())
    assert list(got["ruin"].round(6)) == [1.5, 2.25, 0, 0, 0, 0, 0, 0]


@pytest.mark.parametrize("plan", ["window", "split"])
def test_bucket_edges_between_neighbouring_doubles(spark, plan):
    """The edge at place 2.4 lies between two neighbouring doubles: it is the lower one, as in SQL."""
    values = [0.1, 0.2, 1.097560975609756, 1.0975609756097562, 3.0]
    rows = spark.createDataFrame([("d", str(i), v) for i, v in enumerate(values)], "trade_date string, ts_code string, x double")
    got = {r.ts_code: r.b for r in xs.add_bucket(rows, "x", ["trade_date"], 5, "b", plan=plan).collect()}
    sql = "SELECT list_distinct(quantile_cont(x, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])) FROM (SELECT unnest(?) AS x)"
    edges = duckdb.execute(sql, [values]).fetchone()[0]
    assert got == {str(i): max(1, sum(e < v for e in edges)) for i, v in enumerate(values)} and got["3"] == 4


@pytest.mark.parametrize("plan", ["window", "split"])
def test_bucket_edges_are_the_bits_of_quantile_cont(spark, plan):
    """Groups of neighbouring doubles: an edge that rounds to its upper neighbour in another form stays below it, as in SQL."""
    rng = np.random.default_rng(7)
    rows = []
    for g in range(60):
        x = [float(rng.random() * 2)]
        for step in rng.integers(0, 3, int(rng.integers(3, 40))):
            x.append(x[-1] if step == 0 else float(np.nextafter(x[-1], np.inf)))
        rows += [(f"d{g:02d}", f"{i:03d}", v) for i, v in enumerate(x)]
    rows = [*rows, *[("e", f"{i:03d}", v) for i, v in enumerate([0.1, 0.7589285714285714, 0.7589285714285715, 1.0, 1.2])]]
    df = spark.createDataFrame(rows, "trade_date string, ts_code string, x double")
    got = {(r.trade_date, r.ts_code): r.b for r in xs.add_bucket(df, "x", ["trade_date"], 5, "b", plan=plan).collect()}
    edges = {}
    for d in {r[0] for r in rows}:
        sql = "SELECT list_distinct(quantile_cont(x, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])) FROM (SELECT unnest(?) AS x)"
        edges[d] = duckdb.execute(sql, [[x for e, _, x in rows if e == d]]).fetchone()[0]
    assert got == {(d, c): max(1, sum(e < x for e in edges[d])) for d, c, x in rows}


def test_results_are_rounded_as_sql_rounds(spark):
    values = [s * k / n for n in (640, 128, 3000) for k in range(1, 641) for s in (1, -1)]
    got = [r.x for r in rounded(spark.createDataFrame([(v,) for v in values], "x double").coalesce(1)).collect()]
    assert got == [r[0] for r in duckdb.execute("SELECT round(unnest(?::DOUBLE[]), 6)", [values]).fetchall()]


def test_average_rank_sorts_a_column_once(df):
    plan = xs.add_ranks(df, {"r": "x"}, ["trade_date"], ["ts_code"], "ts_code", method="average", plan="window")
    assert len(re.findall(r"Sort \[.*x#", plan._jdf.queryExecution().sparkPlan().toString() + plan._jdf.queryExecution().executedPlan().toString())) == 1


def test_alternative_composites_read_their_input_once(df):
    rows = df.withColumnsRenamed({"ind": "l2_name", "x": "turn_f_z20", "y": "vol_ratio_z20"})
    plan = factors.alternative_composites(rows, plan="window")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and "Join" not in plan


def test_split_ranks_plan_a_narrow_table_once(spark):
    read = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame([(f"s{i}", i % 3, float(i * 7 % 5)) for i in range(30)], "ts_code string, trade_date int, x double")

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    for method in ("average", "ordinal"):
        before = read.value
        ranked = xs.add_ranks(df.mapInArrow(counted, df.schema), {"r": "x"}, ["trade_date"], ["ts_code"], "ts_code", method=method, plan="split")
        want = xs.add_ranks(df, {"r": "x"}, ["trade_date"], ["ts_code"], "ts_code", method=method, plan="window")
        assert sorted(map(tuple, ranked.collect())) == sorted(map(tuple, want.collect()))
        assert read.value - before == 30


def test_column_quantiles_order_few_values_and_are_exact(spark, monkeypatch):
    from tidepanel.operators import ordered

    rng = np.random.default_rng(3)
    n = 20_000
    frame = pd.DataFrame({"x": rng.normal(size=n), "flag": (rng.random(n) < 0.3).astype(float), "one": np.ones(n)})
    frame.loc[::7, "x"] = np.nan
    df = spark.createDataFrame(frame).select(*[F.nanvl(c, F.lit(None).cast("double")).alias(c) for c in frame], F.lit(None).cast("double").alias("none"))
    probs, ordered_rows, total = {"a": 0.01, "b": 0.5, "c": 0.99}, [], ordered.running_total
    monkeypatch.setattr(ordered, "running_total", lambda rows, *a, **k: ordered_rows.append(rows.count()) or total(rows, *a, **k))
    for how in ("linear", "nearest"):
        got = {r["_var"]: (r.a, r.b, r.c) for r in ordered.column_quantiles(df, ["x", "flag", "one", "none"], probs, how).collect()}
        assert set(got) == {"x", "flag", "one"}
        for c, values in got.items():
            known = np.sort(frame[c].dropna())
            want = [known[int(np.floor(p * (len(known) - 1) + 0.5))] if how == "nearest" else np.quantile(known, p) for p in probs.values()]
            assert np.allclose(values, want, rtol=1e-14, atol=0)
    assert max(ordered_rows) < n / 20  # every distinct value was ordered before
    # brackets that miss their quantile cost time, not exactness
    monkeypatch.setattr(ordered.F, "percentile_approx", lambda x, ps, k: F.transform(ps, lambda p: F.lit(100.0)))
    (row,) = ordered.column_quantiles(df, ["x"], {"b": 0.5}).collect()
    assert row.b == np.quantile(frame["x"].dropna(), 0.5)
