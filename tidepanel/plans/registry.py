"""Feature registry: metadata rows derived from per-domain rules and a few exceptions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.functions.scalars import clip
from tidepanel.functions.timeseries import forward_fill
from tidepanel.operators.cross_section import choose_plan
from tidepanel.operators.ordered import exact_quantiles, null_safe_join
from tidepanel.session import cut_lineage

FIELDS = [
    "feature_name", "domain", "source_table", "freq", "entity_key", "time_key", "source_columns", "formula_desc", "unit_type", "value_type",
    "allow_in_search", "allow_in_model", "fill_policy", "clip_policy", "neutralize_policy", "start_date", "notes",
]

# Registered features per domain (letter, builder, source table, first date, names).
DOMAINS = [
    ("A", "price_volume", "daily", "", ["ret_cc_1d", "ret_oc_1d", "gap_open", "intraday_range", "upper_shadow_ratio", "lower_shadow_ratio", "turnover_free", "volume_ratio_ln"]),
    ("B", "moneyflow", "moneyflow", "20100101", ["imb_sm_amt", "imb_md_amt", "imb_lg_amt", "imb_elg_amt", "net_mf_to_amount", "large_buy_share", "large_sell_share", "flow_divergence"]),
    ("C", "cost", "cyq_perf", "20180101", ["close_vs_cost50", "close_vs_weight_avg", "chip_width_95_5", "chip_width_85_15", "overhang_95", "support_5", "winner_rate_pct", "price_pos_hist"]),
    ("D", "fundamental", "daily_basic", "", ["pe_ttm_rank_ind", "pb_rank_ind", "ps_ttm_rank_ind", "dv_ttm_rank_mkt", "mv_rank_mkt", "free_float_ratio", "circ_mv_to_total_mv", "valuation_compress_score"]),
    ("E", "intraday", "stk_60_mins", "", ["hour1_ret", "lasthour_ret", "midday_reversal", "intraday_trend_eff", "hourly_volatility", "volume_concentration_pm", "vwap_close_bias_1h", "high_low_time_skew"]),
]
# Tables and units that differ from the domain's table and from "ratio".
SOURCE_TABLES = {"daily_basic": ["turnover_free", "volume_ratio_ln"], "moneyflow, daily": ["net_mf_to_amount"],
                 "cyq_perf, daily": ["close_vs_cost50", "close_vs_weight_avg", "chip_width_95_5", "chip_width_85_15", "overhang_95", "support_5", "price_pos_hist"]}
UNITS = {"rank": ["pe_ttm_rank_ind", "pb_rank_ind", "ps_ttm_rank_ind", "dv_ttm_rank_mkt", "mv_rank_mkt"], "score": ["valuation_compress_score", "high_low_time_skew"]}
# Input columns of every feature. The texts behind them are this library's own.
INPUTS = {
    "ret_cc_1d": ("close, pre_close", "relative change from the previous close to the close"),
    "ret_oc_1d": ("close, open", "relative change from the open to the close"),
    "gap_open": ("open, pre_close", "relative change from the previous close to the open"),
    "intraday_range": ("high, low, pre_close", "high less low, over the previous close"),
    "upper_shadow_ratio": ("high, open, close, low", "part of the day's range above the body"),
    "lower_shadow_ratio": ("high, open, close, low", "part of the day's range below the body"),
    "turnover_free": ("turnover_rate_f", "free-float turnover as a fraction"),
    "volume_ratio_ln": ("volume_ratio", "logarithm of one plus the volume ratio"),
    "imb_sm_amt": ("buy_sm_amount, sell_sm_amount", "small orders: bought less sold, over both"),
    "imb_md_amt": ("buy_md_amount, sell_md_amount", "medium orders: bought less sold, over both"),
    "imb_lg_amt": ("buy_lg_amount, sell_lg_amount", "large orders: bought less sold, over both"),
    "imb_elg_amt": ("buy_elg_amount, sell_elg_amount", "largest orders: bought less sold, over both"),
    "net_mf_to_amount": ("net_mf_amount, amount", "net inflow over the day's amount, in one unit"),
    "large_buy_share": ("buy_lg, buy_elg, buy_sm, buy_md", "large and largest orders in all that was bought"),
    "large_sell_share": ("sell_lg, sell_elg, sell_sm, sell_md", "large and largest orders in all that was sold"),
    "flow_divergence": ("imb_elg_amt, imb_sm_amt", "imbalance of the largest orders less that of the small ones"),
    "close_vs_cost50": ("close, cost_50pct", "distance of the close from the median cost"),
    "close_vs_weight_avg": ("close, weight_avg", "distance of the close from the average cost"),
    "chip_width_95_5": ("cost_95pct, cost_5pct, close", "width of the middle 90 % of costs, over the close"),
    "chip_width_85_15": ("cost_85pct, cost_15pct, close", "width of the middle 70 % of costs, over the close"),
    "overhang_95": ("cost_95pct, close", "how far the dearest holders stand above the close"),
    "support_5": ("cost_5pct, close", "how far the cheapest holders stand below the close"),
    "winner_rate_pct": ("winner_rate", "holders in profit as a fraction"),
    "price_pos_hist": ("close, his_low, his_high", "place of the close between historical low and high"),
    "pe_ttm_rank_ind": ("pe_ttm, industry", "rank of the earnings multiple inside the industry"),
    "pb_rank_ind": ("pb, industry", "rank of the book multiple inside the industry"),
    "ps_ttm_rank_ind": ("ps_ttm, industry", "rank of the sales multiple inside the industry"),
    "dv_ttm_rank_mkt": ("dv_ttm", "rank of the dividend yield in the market"),
    "mv_rank_mkt": ("total_mv", "rank of the market value in the market"),
    "free_float_ratio": ("free_share, total_share", "free shares in all shares"),
    "circ_mv_to_total_mv": ("circ_mv, total_mv", "circulating value in the total value"),
    "valuation_compress_score": ("pe_ttm_rank, pb_rank, ps_ttm_rank", "negative weighted sum of three multiple ranks: 0.4, 0.4, 0.2"),
    "hour1_ret": ("close_h1, open_h1", "relative change over the first hour"),
    "lasthour_ret": ("close_last, open_last", "relative change over the last hour"),
    "midday_reversal": ("lasthour_ret, hour1_ret", "last hour's change less the first hour's"),
    "intraday_trend_eff": ("day_ret, sum_abs_hourly_ret", "the day's change over the sum of absolute hourly changes"),
    "hourly_volatility": ("hourly_returns", "standard deviation of the hourly changes"),
    "volume_concentration_pm": ("vol_pm, vol_total", "afternoon volume in the day's volume"),
    "vwap_close_bias_1h": ("close, vwap_1h", "distance of the close from the volume-weighted price"),
    "high_low_time_skew": ("high_time, low_time", "bars from the low to the high, over the day's bars"),
}
# Fields of the domain registry, and their processing where it is not the clipping policy alone.
DOMAIN_FIELDS = ["ret_cc_1d", "gap_open", "intraday_range", "volume_ratio_ln", "upper_shadow_ratio", "lower_shadow_ratio", "net_mf_to_amount", "imb_sm_amt", "imb_md_amt", "imb_lg_amt", "imb_elg_amt", "flow_divergence",
                 "price_pos_hist", "winner_rate_pct", "chip_width_95_5", "overhang_95", "intraday_trend_eff", "high_low_time_skew"]
PROCESSING = {"volume_ratio_ln": "Log1p transformed", "net_mf_to_amount": "Winsorized (1%-99%), Missing filled with 0", "imb_sm_amt": "Missing filled with 0", "imb_md_amt": "Missing filled with 0",
              "imb_lg_amt": "Missing filled with 0", "imb_elg_amt": "Missing filled with 0", "flow_divergence": "Missing filled with 0", "winner_rate_pct": "Clipped [0, 1]"}
# Policies that differ from "none".
FILL = {"imb_": "zero_if_both_zero_else_nan", "net_mf_to_amount": "nan_if_amount_zero", "close_vs_": "ffill_1d_if_single_gap", "chip_width_": "ffill_1d_if_single_gap",
        "overhang_": "ffill_1d_if_single_gap", "support_": "ffill_1d_if_single_gap", "winner_rate_pct": "clip_0_1", "_rank_ind": "industry_median", "dv_ttm_rank_mkt": "zero"}
CLIP = {"clip_1_99": ["ret_cc_1d", "gap_open", "intraday_range", "net_mf_to_amount", "chip_width_95_5", "overhang_95"],
        "clip_0_1_robust": ["price_pos_hist"], "clip_20": ["intraday_trend_eff"]}
NEUTRALIZE = {"optional_cs": ["turnover_free", "volume_ratio_ln", "net_mf_to_amount"], "industry_rank": ["pe_ttm_rank_ind", "pb_rank_ind", "ps_ttm_rank_ind"]}


def _policy(name: str, table: dict[str, list[str]], otherwise: str = "none") -> str:
    return next((p for p, names in table.items() if name in names), otherwise)


def feature_registry_rows() -> list[dict]:
    rows = []
    for letter, builder, source, start, names in DOMAINS:
        for name in names:
            fill_policy = next((p for part, p in FILL.items() if part in name), "none")
            rows.append(
                dict(zip(FIELDS, [
                    name, letter, _policy(name, SOURCE_TABLES, source), "daily", "ts_code", "trade_date", INPUTS[name][0], INPUTS[name][1], _policy(name, UNITS, "ratio"), "float",
                    int(letter != "D"), 1, fill_policy, _policy(name, CLIP), _policy(name, NEUTRALIZE), start, f"column of the {builder} feature table",
                ]))
            )
    return rows


def feature_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(feature_registry_rows()).select(*FIELDS)


def domain_registry(spark: SparkSession) -> DataFrame:
    """Field, domain, description and documented processing."""
    words = {"clip_1_99": "Winsorized (1%-99%)", "clip_0_1_robust": "Clipped [0, 1]", "clip_20": "Clipped [-20, 20]", "none": "None"}
    known = {r["feature_name"]: r for r in feature_registry_rows()}
    rows = [{"field_name": n, "domain": known[n]["domain"], "desc": known[n]["formula_desc"], "processing": PROCESSING.get(n, words[known[n]["clip_policy"]])} for n in DOMAIN_FIELDS]
    return spark.createDataFrame(rows).select("field_name", "domain", "desc", "processing")


def _columns_of(name: str, available: Sequence[str]) -> list[str]:
    return [c for c in available if c == name or (c.startswith(f"{name}_") and c.rsplit("_", 1)[-1] in ("raw", "robust", "valid", "log", "capped"))]


def selected_features(selector: str, builders: Sequence[str]) -> list[str]:
    """Feature-table columns whose registry row has ``selector`` set."""
    from tidepanel.plans.domains import FEATURES

    wanted = [r["feature_name"] for r in feature_registry_rows() if r[selector] == 1]
    return [c for b in builders for name in wanted for c in _columns_of(name, FEATURES[b])]


def _with_quantiles(df: DataFrame, cols: Sequence[str], by: Sequence[str], probs: dict[str, float], plan: str) -> DataFrame:
    """Append ``{prefix}{column}`` for every prefix of ``probs``; the split plan ranks all columns in one scan."""
    if not cols:
        return df
    if plan == "window":
        w = Window.partitionBy(*by)
        return df.withColumns({f"{k}{c}": F.percentile(c, F.lit(p)).over(w) for c in cols for k, p in probs.items()})
    short = {c: f"_{i}" for i, c in enumerate(cols)}  # the names travel with every value
    long = df.select(*by, *[F.col(c).cast("double").alias(name) for c, name in short.items()]).unpivot(list(by), list(short.values()), "_var", "_x")
    found = exact_quantiles(long, ["_var", *by], "_x", probs)
    wide = found.groupBy(*by).agg(*[F.max(F.when(F.col("_var") == name, F.col(k))).alias(f"{k}{c}") for c, name in short.items() for k in probs])
    return null_safe_join(df, wide, by)


def apply_policies(df: DataFrame, columns: dict[str, str], industry: str = "l1_name", date: str = "trade_date", plan: str = "auto", width: int | None = None) -> DataFrame:
    """Fill, then clip, each ``{column: registered feature}`` as its registry row says.

    Policies about empty or zero denominators are already met when features are built.
    """
    rows = {r["feature_name"]: r for r in feature_registry_rows()}
    plan = choose_plan(df, [date], plan, width)
    original = df.columns
    fill, cut = ({c: rows[feature][policy] for c, feature in columns.items()} for policy in ("fill_policy", "clip_policy"))
    # before all else: rows that come dealt by entity are not dealt again
    gaps = [c for c in columns if fill[c] == "ffill_1d_if_single_gap"]
    df = df.withColumns({c: forward_fill(c, Window.partitionBy("ts_code").orderBy(date), limit=1) for c in gaps})
    if plan == "split":
        df = cut_lineage(df)  # medians, cuts and the result read it
    df = _with_quantiles(df, [c for c in columns if fill[c] == "industry_median"], [date, industry], {"_median_": 0.5}, plan)
    filled = {
        "zero": lambda c: F.coalesce(c, F.lit(0.0)),
        "industry_median": lambda c: F.coalesce(c, f"_median_{c}"),
        "clip_0_1": lambda c: clip(c, 0.0, 1.0),
    }
    df = df.withColumns({c: filled[fill[c]](c) for c in columns if fill[c] in filled}).select(*original)
    df = _with_quantiles(df, [c for c in columns if cut[c] == "clip_1_99"], [date], {"_lo_": 0.01, "_hi_": 0.99}, plan)
    clipped = {"clip_1_99": lambda c: clip(c, F.col(f"_lo_{c}"), F.col(f"_hi_{c}")), "clip_0_1_robust": lambda c: clip(c, 0.0, 1.0), "clip_20": lambda c: clip(c, -20.0, 20.0)}
    return df.withColumns({c: clipped[cut[c]](c) for c in columns if cut[c] in clipped}).select(*original)
