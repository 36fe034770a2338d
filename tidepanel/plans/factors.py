"""Point-in-time factor library: daily factors, reported factors, composites."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions import timeseries as ts
from tidepanel.functions.scalars import OPEN_END_DATE, column_or, fill, lenient_double, parse_date, ratio
from tidepanel.operators.cross_section import add_bucket, add_ranks, choose_plan
from tidepanel.operators.dedup import keep_last
from tidepanel.operators.neutralize import neutralize
from tidepanel.operators.ordered import null_safe_join
from tidepanel.operators.pit import asof_join, interval_asof, interval_range
from tidepanel.session import cut_lineage

INDUSTRY = ["l1_name", "l2_name", "l3_name"]

# Reported metrics ranked upwards and downwards, and the composite weights.
HIGHER_IS_BETTER = [
    "roe_dt", "q_dt_roe", "roic", "netprofit_margin", "q_ocf_to_sales", "ocfps", "dt_netprofit_yoy", "q_op_qoq",
    "roe_yoy", "assets_turn", "ar_turn", "current_ratio", "ocf_to_debt", "ebit_ps", "profit_to_op", "ebitda_to_debt",
]
LOWER_IS_BETTER = ["debt_to_assets", "turn_days", "debt_to_eqt"]
#: The reported columns that the factors are made of.
REPORTED = [*dict.fromkeys([*HIGHER_IS_BETTER[:-1], *LOWER_IS_BETTER, "ebitda", "interestdebt", "tr_yoy", "profit_to_gr"])]
COMPOSITES = {
    "comp_value_quality": {"ep_ttm_rank_ind_l2": 0.35, "bp_rank_ind_l2": 0.25, "roe_dt_ind_rank": 0.20, "q_ocf_to_sales_ind_rank": 0.20},
    "comp_margin_improvement": {"profit_to_gr_ind_rank": 0.25, "q_ocf_to_sales_ind_rank": 0.25, "q_op_qoq_ind_rank": 0.25, "dt_netprofit_yoy_ind_rank": 0.25},
    "comp_anti_crowded_val": {"bp_rank_ind_l2": 0.40, "div_ttm_rank_ind_l1": 0.30, "turn_f_z20_ind_rank": -0.15, "vol_ratio_z20_ind_rank": -0.15},
    "comp_efficiency_growth": {"assets_turn_ind_rank": 0.30, "ar_turn_ind_rank": 0.20, "turn_days_ind_rank": 0.20, "dt_netprofit_yoy_ind_rank": 0.30},
    "comp_quality_safety": {"current_ratio_ind_rank": 0.25, "ocf_to_debt_ind_rank": 0.25, "ebitda_to_debt_ind_rank": 0.25, "debt_to_assets_ind_rank": 0.25},
}
ALTERNATIVE_COMPOSITES = {
    "comp_value_quality": {"ep_ttm_rank_ind_l2": 0.35, "bp_rank_ind_l2": 0.25, "roe_dt_ind_rank": 0.20, "ocf_to_or_ind_rank": 0.20},
    "comp_margin_improvement": {"q_profit_to_gr_ind_rank": 0.25, "q_ocf_to_sales_ind_rank": 0.25, "q_op_qoq_ind_rank": 0.25, "dt_netprofit_yoy_ind_rank": 0.25},
    "comp_anti_crowded_val": COMPOSITES["comp_anti_crowded_val"],
    "comp_efficiency_growth": {"assets_turn_ind_rank": 0.30, "ar_turn_ind_rank": 0.20, "inv_turn_ind_rank": 0.20, "q_sales_yoy_ind_rank": 0.30},
    "comp_quality_safety": COMPOSITES["comp_quality_safety"],
}


def membership_intervals(members: DataFrame) -> DataFrame:
    """Text-dated memberships as typed intervals; an open end is far in the future."""
    return members.withColumns({"in_date": parse_date("in_date"), "out_date": parse_date(fill("out_date", OPEN_END_DATE))})


def effective_reports(reports: DataFrame, metrics: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Reports by announcement date; of several on one day the latest period counts."""
    typed = reports.select("ts_code", *[c for c in tie], *metrics, parse_date("ann_date").alias("ann_date"), parse_date("end_date").alias("end_date"))
    return keep_last(typed.where(F.col("ann_date").isNotNull()), ["ts_code", "ann_date"], ["end_date", *tie])


def point_in_time_panel(
    basic: DataFrame, members: DataFrame, reports: DataFrame | None, metrics: Sequence[str] = (), how: str = "inner", report_tie: Sequence[str] = ()
) -> DataFrame:
    """Daily rows with the industry valid that day and the last report announced by then.

    ``how="inner"`` drops rows without a valid industry, ``how="left"`` keeps them as
    ``Unknown``. Rows are unique by (entity, date), reports become unique by (entity, announcement date) and an
    entity's memberships are few, so the calendar bounds every key.
    """
    intervals = membership_intervals(members)
    if how == "inner":
        df = interval_asof(basic, intervals, "ts_code", "trade_date", "in_date", "out_date", INDUSTRY, bounded=True)
    else:
        df = interval_range(basic, intervals, "ts_code", "trade_date", "in_date", "out_date", INDUSTRY)
    df = df.drop("in_date", "out_date")
    if reports is not None:
        known = effective_reports(reports, metrics, report_tie)
        df = asof_join(df, known, ["ts_code"], "trade_date", "ann_date", [*metrics, "ann_date"], bounded=True)
        df = df.withColumns({m: lenient_double(m) for m in metrics})
    return df.withColumns({c: fill(c, "Unknown") for c in INDUSTRY})


def base_factors(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "ep_ttm": ratio(F.lit(1.0), "pe_ttm"), "bp": ratio(F.lit(1.0), "pb"), "sp_ttm": ratio(F.lit(1.0), "ps_ttm"),
            "div_ttm_val": F.col("dv_ttm") / 100,
            "turn_f": F.log1p("turnover_rate_f"), "vol_ratio": F.log1p("volume_ratio"), "log_size": F.ln("circ_mv"),
            "ff_ratio": ratio("free_share", "float_share"),
        }
    )


def history_factors(df: DataFrame) -> DataFrame:
    """All per-entity windows in one projection: one shuffle by entity, one sort."""
    w = ts.entity_window()
    return df.withColumns(
        {
            **{f"ep_ttm_lag{k}": ts.lag("ep_ttm", k, w) for k in (1, 5, 20)},
            "ep_ttm_chg20": ts.roc("ep_ttm", 20, w),
            "turn_f_chg5": ts.roc("turn_f", 5, w),
            "pb_compress_20": ts.roc("pb", 20, w),
            "pe_re_rate_20": ts.roc("pe_ttm", 20, w),
            "turn_f_z20": ts.zscore("turn_f", 20, w),
            "vol_ratio_z20": ts.zscore("vol_ratio", 20, w),
        }
    )


def _rank(df: DataFrame, ranks: dict[str, str], level: str, plan: str, width: int | None, down: Sequence[str] = (), min_n: int = 0) -> DataFrame:
    return add_ranks(df, ranks, ["trade_date", level], ["ts_code"], "ts_code", descending=down, min_n=min_n, plan=plan, width=width)


def daily_ranks(df: DataFrame, plan: str = "window", width: int | None = None) -> DataFrame:
    l2 = {
        "ep_ttm_rank_ind_l2": "ep_ttm", "bp_rank_ind_l2": "bp", "turn_f_rank_ind_l2": "turn_f",
        "turn_f_chg5_ind_rank": "turn_f_chg5", "pb_compress_20_ind_rank": "pb_compress_20",
    }
    df = _rank(df, l2, "l2_name", plan, width)
    df = _rank(df, {"div_ttm_rank_ind_l1": "div_ttm_val"}, "l1_name", plan, width)
    return df.withColumns(
        {
            "anti_crowding": -(fill("turn_f_z20", 0.0) + fill("vol_ratio_z20", 0.0)),
            "value_recovery": F.col("bp_rank_ind_l2") - F.col("turn_f_rank_ind_l2"),
        }
    )


def daily_factors(df: DataFrame, plan: str = "window", width: int | None = None) -> DataFrame:
    """Dealt by date where a date's market fits a task: all ranks inside industries, of any level, then read one shuffle."""
    df = history_factors(base_factors(df))
    by_date = plan == "window" or plan == "auto" and width is not None and choose_plan(df, ["trade_date"], plan, width) == "window"
    return daily_ranks(df.repartition("trade_date") if by_date else df, plan, width)


def reported_factors(df: DataFrame, plan: str = "window", width: int | None = None) -> DataFrame:
    df = df.withColumn("ebitda_to_debt", fill(ratio("ebitda", "interestdebt"), 0.0))
    ranks = {f"{m}_ind_rank": m for m in [*HIGHER_IS_BETTER, *LOWER_IS_BETTER, "tr_yoy", "profit_to_gr"]}
    df = _rank(df, ranks, "l2_name", plan, width, down=[f"{m}_ind_rank" for m in LOWER_IS_BETTER])
    growth = (fill("tr_yoy_ind_rank", 0.0) + fill("dt_netprofit_yoy_ind_rank", 0.0)) / 2
    return df.withColumn("growth_consistency_ind_rank", growth)


def weighted_sum(df: DataFrame, weights: dict[str, float], strict: Sequence[str] = (), default: float | None = 0.0) -> Column:
    """Weighted sum where a NULL term counts as ``default`` unless listed in ``strict``;
    an absent column counts as 0."""
    def term(name: str, weight: float) -> Column:
        value = column_or(df, name, 0.0)
        if default is not None and name not in strict:
            value = fill(value, default)
        return F.lit(weight) * value

    return reduce(add, [term(n, w) for n, w in weights.items()])


def composites(df: DataFrame, plan: str = "window", width: int | None = None) -> DataFrame:
    """Five weighted composites. A missing ``profit_to_gr`` rank leaves its composite missing."""
    df = _rank(df, {f"{x}_ind_rank": x for x in ("turn_f_z20", "vol_ratio_z20")}, "l2_name", plan, width)
    return df.withColumns({name: weighted_sum(df, w, strict=["profit_to_gr_ind_rank"]) for name, w in COMPOSITES.items()})


def alternative_composites(df: DataFrame, plan: str = "auto", width: int | None = None) -> DataFrame:
    """Variant on other inputs: absent columns count as 0, NULL terms stay NULL. The two
    crowding ranks are average-tie, in industries of at least five rows."""
    missing = {f"{x}_ind_rank": x for x in ("turn_f_z20", "vol_ratio_z20") if f"{x}_ind_rank" not in df.columns}
    if missing:
        by = ["trade_date", "l2_name"]
        plan = choose_plan(df, by, plan, width)
        if plan == "window":
            rows = add_ranks(df, missing, by, ["ts_code"], "ts_code", method="average", plan=plan)
            rows = rows.withColumn("_rows", F.count(F.lit(1)).over(Window.partitionBy(*by)))
        else:
            df = cut_lineage(df)  # ranks and counts read it three times
            rows = add_ranks(df, missing, by, ["ts_code"], "ts_code", method="average", plan=plan, stored=True)
            rows = null_safe_join(rows, df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows")), by)
        df = rows.withColumns({r: F.when(F.col("_rows") >= 5, F.col(r)) for r in missing}).drop("_rows")
    return df.withColumns({name: weighted_sum(df, w, default=None) for name, w in ALTERNATIVE_COMPOSITES.items()})


def factor_panel(basic: DataFrame, members: DataFrame, reports: DataFrame, metrics: Sequence[str], width: int | None = None, report_tie: Sequence[str] = ()) -> DataFrame:
    """Everything above plus the neutralized earnings yield.

    Shuffles: one by entity for joins and lags, then one by date, which serves the
    market windows and, being coarser, every (date, industry) window as well.
    """
    df = point_in_time_panel(basic, members, reports, metrics, report_tie=report_tie)
    df = history_factors(base_factors(df))
    plan = choose_plan(df, ["trade_date"], width=width)
    if plan == "window":
        df = df.repartition("trade_date")
    df = composites(reported_factors(daily_ranks(df, plan), plan), plan)
    return neutralize(df, "ep_ttm", "ep_ttm_neu", industry="l1_name", sizes=["log_size"], plan=plan)


def templated(df: DataFrame, columns: Sequence[str], level: str = "l2_name", k: int = 20, q: int = 5, plan: str = "auto", width: int | None = None) -> DataFrame:
    """The operator template (lag, change, difference, z-score, own percentile, ranks,
    bucket) applied to every listed column."""
    w = ts.entity_window()
    made = {}
    for c in columns:
        made |= {
            f"{c}_lag": ts.lag(c, 1, w), f"{c}_roc": ts.roc(c, k, w), f"{c}_diff": ts.diff(c, k, w),
            f"{c}_z": ts.zscore(c, k, w), f"{c}_pct": ts.rolling_percentile(c, k, w),
        }
    out = df.withColumns(made)
    plan = choose_plan(out, ["trade_date"], plan, width)
    out = _rank(out, {f"{c}_ind_rank": c for c in columns}, level, plan, None)
    # a window sorts once for a column's rank and bucket; the split plan ranks all columns in one pass
    for cols in [[c] for c in columns] if plan == "window" else [list(columns)]:
        out = add_ranks(out, {f"{c}_rank": c for c in cols}, ["trade_date"], ["ts_code"], "ts_code", plan=plan)
        for c in cols:
            out = add_bucket(out, c, ["trade_date"], q, f"{c}_bucket", plan=plan, tie=["ts_code"])
    return out


def interaction(a: str, b: str) -> Column:
    return F.col(a) * F.col(b)
