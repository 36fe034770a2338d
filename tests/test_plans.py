"""Domain tables, composites, registry and universe on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import universe as un
from tidepanel.operators.neutralize import apply_by_date, neutralize
from tidepanel.plans import domains, factors, registry
from tidepanel.sources.star_views import FINANCIAL_COLUMNS, StarViews

D = dt.date(2024, 1, 2)


def test_invalid_bar_keeps_its_robust_return(spark):
    bars = [("a", D, 10.0, 11.0, 9.0, 10.5, 10.0), ("b", D, 10.0, 9.5, 9.0, 30.0, 10.0), ("c", D, 10.0, 10.01, 10.0, 10.0, 0.05)]
    daily = spark.createDataFrame(bars, "ts_code string, trade_date date, open double, high double, low double, close double, pre_close double")
    basic = spark.createDataFrame([("a", D, 3.0, 1.0), ("b", D, 0.0, None)], "ts_code string, trade_date date, turnover_rate_f double, volume_ratio double")
    got = {r.ts_code: r for r in domains.price_volume(daily, basic).collect()}
    assert got["b"].ohlc_invalid_flag == 1 and got["b"].ret_cc_1d_raw is None and got["b"].ret_cc_1d_robust is not None
    assert got["b"].turnover_free_log is None and got["c"].turnover_free_raw is None
    assert got["c"].tiny_preclose_flag == 1 and got["c"].ret_cc_1d_suspect_flag == 1
    assert got["a"].upper_shadow_ratio_raw == pytest.approx(0.25) and got["a"].range_too_small_flag == 0


def test_moneyflow_flags_and_units(spark):
    legs = [f"{s}_{z}_amount" for z in domains.LEGS for s in ("buy", "sell")]
    daily = spark.createDataFrame([("a", D, 1000.0), ("b", D, 0.0), ("c", D, None)], "ts_code string, trade_date date, amount double")
    flow = spark.createDataFrame([("a", D, *[1.0] * 6, None, 0.0, 5.0), ("b", D, *[0.0] * 8, 0.0)], "ts_code string, trade_date date, " + ", ".join(f"{x} double" for x in [*legs, "net_mf_amount"]))
    got = {r.ts_code: r for r in domains.moneyflow(daily, flow).collect()}
    a, b, c = got["a"], got["b"], got["c"]
    assert a.imb_sm_amt_valid == 0.0 and a.imb_sm_amt_micro_den_flag == 1 and a.net_mf_to_amount_valid == pytest.approx(0.05)
    assert a.imb_elg_amt_missing_input_flag == 1 and a.imb_elg_amt_valid is None and a.large_buy_share_valid is None
    assert b.imb_sm_amt_den_zero_flag == 1 and b.amount_nonpositive_flag == 1 and b.net_mf_to_amount_valid is None
    assert c.buy_sm_amount_missing_flag == 1 and c.amount_nonpositive_flag == 0


def test_one_bar_day_has_no_ratios(spark):
    bars = spark.createDataFrame(
        [("a", "2024-01-02 10:00:00", 1.0, 2.0, 1.0, 2.0, -3.0, 6.0), ("b", "2024-01-02 10:00:00", 1.0, 3.0, 1.0, 2.0, 1.0, 2.0), ("b", "2024-01-02 15:00:00", 2.0, 3.0, 0.5, 1.0, 1.0, 2.0),
         ("b", "2024-01-02 15:00:00", 2.0, 3.0, 0.5, 1.0, 1.0, 2.0)],
        "ts_code string, trade_time string, open double, high double, low double, close double, vol double, amount double")
    got = {r.ts_code: r for r in domains.intraday(bars).collect()}
    a, b = got["a"], got["b"]
    assert a.low_bar_count_flag == 1 and a.hour1_ret is None and a.high_low_time_skew is None and a.vol_total == 3.0
    assert b["count"] == 2 and b.high_time_idx == 0 and b.low_time_idx == 1 and b.high_low_time_skew == -1.0
    assert b.hour1_ret == 1.0 and b.lasthour_ret == -0.5 and b.midday_reversal == -1.5 and b.volume_concentration_pm == 0.5


def test_composite_missing_rules(spark):
    df = spark.createDataFrame([(0.5, None)], "q_ocf_to_sales_ind_rank double, profit_to_gr_ind_rank double")
    w = factors.COMPOSITES["comp_margin_improvement"]
    assert df.select(factors.weighted_sum(df, w, strict=["profit_to_gr_ind_rank"])).first()[0] is None
    assert df.select(factors.weighted_sum(df, w)).first()[0] == pytest.approx(0.125)
    assert df.select(factors.weighted_sum(df, {"absent": 1.0}, default=None)).first()[0] == 0.0


def test_model_panel_skips_missing_tables(spark):
    price = spark.createDataFrame([("a", D, 1.0)], "ts_code string, trade_date date, p double")
    flow = spark.createDataFrame([("b", D, 1.0)], "ts_code string, trade_date date, f double")
    assert domains.model_panel(price, flow=flow, cost=None).first().f is None
    with pytest.raises(ValueError):
        domains.model_panel(None, flow=flow)


def test_model_panel_joins_without_a_shuffle(spark):
    """The stored tables meet bucket by bucket."""
    rows = spark.range(500).select(F.concat(F.lit("c"), (F.col("id") % 50).cast("string")).alias("ts_code"), F.date_add(F.lit(D), (F.col("id") / 50).cast("int")).alias("trade_date"), "id")
    tables = {n: rows.where(F.col("id") % k != 0).withColumnRenamed("id", n) for k, n in ((3, "flow"), (5, "cost"), (7, "bars"))}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        panel = domains.model_panel(rows.withColumnRenamed("id", "price"), colocate=True, **tables)
        assert "Exchange" not in panel._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    got = panel.agg(F.count("*"), F.count("flow"), F.count("cost"), F.count("bars"), F.sum((F.col("flow") == F.col("price")).cast("int"))).first()
    assert tuple(got) == (500, 333, 400, 428, 333)


def test_registry_shape_and_selectors(spark):
    reg = registry.feature_registry(spark)
    assert (reg.count(), len(reg.columns)) == (40, 17)
    assert reg.where("allow_in_search = 0").agg(F.collect_set("domain")).first()[0] == ["D"]
    assert registry.domain_registry(spark).where("field_name = 'intraday_trend_eff'").first().processing == "Clipped [-20, 20]"
    assert "pe_ttm_rank_ind" not in registry.selected_features("allow_in_search", ["fundamental"])
    assert "pe_ttm_rank_ind" in registry.selected_features("allow_in_model", ["fundamental"])


def test_registry_policies(spark):
    rows = [("a", dt.date(2024, 1, n), "i", x, y) for n, x, y in ((1, 1.0, 50.0), (2, None, -50.0), (3, None, 3.0))]
    df = spark.createDataFrame(rows, "ts_code string, trade_date date, l1_name string, gap double, eff double")
    got = registry.apply_policies(df, {"gap": "support_5", "eff": "intraday_trend_eff"}).orderBy("trade_date").collect()
    assert [r.gap for r in got] == [1.0, 1.0, None] and [r.eff for r in got] == [20.0, -20.0, 3.0]


@pytest.mark.parametrize("target", [4, 30])
def test_pool_never_exceeds_strata_and_is_stable(spark, target):
    rows = [(D, f"c{i:03d}", f"ind{i % 4}", float(i + 1), float((i * 37) % 101 + 1)) for i in range(60)]
    df = un.with_size_bucket(spark.createDataFrame(rows, "rebal_date date, ts_code string, industry_label string, circ_mv double, score double"))
    one = {r.ts_code for r in un.build_pool(df, target).collect()}
    two = {r.ts_code for r in un.build_pool(df.repartition(5), target, plan="split").collect()}
    assert one == two and 0 < len(one) <= target
    quota = {(r.industry_label, r.bucket): r.b_seats for r in un.bucket_quotas(df, un.industry_quotas(df, target)).collect()}
    picked = un.build_pool(df, target).groupBy("industry_label", "bucket").count().collect()
    assert all(r["count"] <= quota[(r.industry_label, r.bucket)] for r in picked)


def test_factor_panel_is_blind_to_input_order(spark, sf_dir):
    v = StarViews(spark, sf_dir)
    def run(shuffled):
        order = (lambda x: x.repartition(3)) if shuffled else (lambda x: x)
        df = factors.daily_factors(factors.point_in_time_panel(order(v.daily_basic()), order(v.industry_pit()), None))
        return {(r.ts_code, r.trade_date): r.value_recovery for r in df.select("ts_code", "trade_date", "value_recovery").collect()}
    assert run(False) == run(True)


def test_factor_panel_is_the_same_on_the_split_plan(spark, sf_dir):
    v = StarViews(spark, sf_dir).staged("daily_basic", "industry_pit")
    reports = v.fina_indicator()
    cols = ["ts_code", "trade_date", "value_recovery", "roe_dt_ind_rank", "debt_to_assets_ind_rank", *factors.COMPOSITES, "ep_ttm_neu"]

    def run(width):
        df = factors.factor_panel(v.daily_basic(), v.industry_pit(), reports, FINANCIAL_COLUMNS, width, ["report_type"])
        return sorted((tuple(None if x is None else round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(cols).collect()), key=lambda r: r[:2])

    assert run(10) == run(10**9)


def test_apply_by_date_runs_user_functions(spark):
    df = spark.createDataFrame([("d", "a", 1.0), ("d", "b", 3.0), ("e", "a", 5.0)], "trade_date string, ts_code string, x double")
    out = apply_by_date(df, lambda pdf: pdf.assign(x=pdf.x - pdf.x.mean()), "trade_date string, ts_code string, x double")
    assert sorted(r.x for r in out.collect()) == [-1.0, 0.0, 1.0]


def test_split_policies_scan_all_columns_together(spark, monkeypatch):
    scans, quantiles = [], registry.exact_quantiles
    monkeypatch.setattr(registry, "exact_quantiles", lambda *a, **k: scans.append(a) or quantiles(*a, **k))
    rows = [(f"s{i}", D + dt.timedelta(j), None if (i, j) == (0, 0) else "x" if i % 2 else "y", None if (i + j) % 5 == 0 else float(i * 7 % 11), float(i * i % 13), float(-i)) for i in range(12) for j in range(3)]
    df = spark.createDataFrame(rows, "ts_code string, trade_date date, l1_name string, p double, q double, r double")
    columns = {"p": "pe_ttm_rank_ind", "q": "ret_cc_1d", "r": "gap_open"}
    got = [sorted(map(str, registry.apply_policies(df, columns, plan=plan).collect())) for plan in ("window", "split")]
    assert got[0] == got[1] and len(got[0]) == len(rows) and len(scans) == 2


def _shuffles(df, by=""):
    """Shuffles of a plan (by keys that begin with ``by``), joins by broadcast and adaptive help left out."""
    spark, names = df.sparkSession, ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    old = [spark.conf.get(n) for n in names]
    try:
        for n, value in zip(names, ("false", "-1")):
            spark.conf.set(n, value)
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for n, value in zip(names, old):
            spark.conf.set(n, value)
    return plan.count(f"Exchange hashpartitioning({by}")


def test_views_shuffle_line_items_once_a_key(spark, sf_dir):
    """Reports: lines and orders by order, then once by entity. Basics: cells, sold parts and their prices, what was sold by cell, entity, shares."""
    v = StarViews(spark, sf_dir)
    assert _shuffles(v.fina_indicator()) == 3
    assert _shuffles(v.daily_basic()) == 6


def test_ranks_of_several_levels_read_one_shuffle(spark, sf_dir):
    v = StarViews(spark, sf_dir)
    panel = factors.point_in_time_panel(v.daily_basic(), v.industry_pit(), None)
    for how in ({"plan": "auto", "width": v.width}, {"plan": "window"}):
        assert _shuffles(factors.daily_factors(panel, **how).select("div_ttm_rank_ind_l1", "value_recovery"), "trade_date") == 1


def _counted(df, read):
    def run(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(run, df.schema)


def test_split_plans_read_their_input_once(spark):
    rows = [(f"s{i:02d}", D + dt.timedelta(j), "xy"[i % 2], float(i * 7 % 11 + 1), float(i * i % 13 + j + 1)) for i in range(32) for j in range(2)]
    df = spark.createDataFrame(rows, "ts_code string, trade_date date, l1_name string, p double, q double")
    read = spark.sparkContext.accumulator(0)
    got, want = (neutralize(x, "p", "r", sizes=["q"], plan=plan) for x, plan in ((_counted(df, read), "split"), (df, "window")))
    assert [round(r.r, 9) for r in got.orderBy("trade_date", "ts_code").collect()] == [round(r.r, 9) for r in want.orderBy("trade_date", "ts_code").collect()]
    assert read.value == len(rows)
    basic = df.select("ts_code", "trade_date", *[F.col("p").alias(c) for c in ("pe_ttm", "pb", "ps_ttm", "dv_ttm")], *[F.col("q").alias(c) for c in ("total_share", "free_share", "total_mv", "circ_mv")])
    read = spark.sparkContext.accumulator(0)
    got, want = (domains.fundamental(df, x, plan=plan) for x, plan in ((_counted(basic, read), "split"), (basic, "window")))
    assert sorted(map(str, got.select(sorted(got.columns)).collect())) == sorted(map(str, want.select(sorted(got.columns)).collect())) and read.value == len(rows)


def test_split_policies_fill_gaps_before_they_store(spark):
    df = spark.createDataFrame([("a", D, "x", 1.0), ("a", D + dt.timedelta(1), "x", None)], "ts_code string, trade_date date, l1_name string, c double")
    filled = registry.apply_policies(df, {"c": "close_vs_cost50"}, plan="split")
    assert [r.c for r in filled.collect()] == [1.0, 1.0] and _shuffles(filled, "ts_code") == 0
