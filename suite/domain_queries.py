"""Domain feature tables and the model panel."""

from __future__ import annotations


from suite.common import ORACLES, query
from suite.factor_queries import KEYS, avg_rank_sql
from suite.view_sql import rounded as r_sql
from suite.view_sql import with_views
from tidepanel.plans import domains as dom
from tidepanel.plans.registry import apply_policies, feature_registry_rows, selected_features


def div_sql(n: str, d: str, m: str = "1e-4") -> str:
    return f"CASE WHEN abs({d}) >= {m} THEN ({n}) / ({d}) END"


def flag_sql(cond: str) -> str:
    return f"CAST(coalesce({cond}, FALSE) AS INTEGER)"


def sigma_ctes(src: str, outs: dict[str, str], name: str, n: float = 5.0) -> dict[str, str]:
    stats = ", ".join(f"avg({c}) AS m_{i}, stddev_samp({c}) AS s_{i}" for i, c in enumerate(outs.values()))
    cols = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, m_{i} - {n} * s_{i}), m_{i} + {n} * s_{i}) END AS {o}" for i, (o, c) in enumerate(outs.items())
    )
    return {f"{name}_st": f"SELECT {stats} FROM {src}", name: f"SELECT t.*, {cols} FROM {src} t, {name}_st"}


# ------------------------------------------------------------------ A: price and volume
_A_MASKED = ["ret_cc_1d", "ret_oc_1d", "gap_open", "intraday_range"]
_A0 = f"""SELECT d.*, turnover_rate_f, volume_ratio,
    coalesce(open > 0.05 AND high > 0.05 AND low > 0.05 AND d.close > 0.05 AND high >= greatest(open, d.close) - 1e-4
        AND low <= least(open, d.close) + 1e-4 AND high >= low, FALSE) AS valid,
    {div_sql('d.close - pre_close', 'pre_close')} AS u_ret_cc_1d, {div_sql('d.close - open', 'open')} AS u_ret_oc_1d,
    {div_sql('open - pre_close', 'pre_close')} AS u_gap_open, {div_sql('high - low', 'pre_close')} AS u_intraday_range,
    {flag_sql('high - low < pre_close * 0.005')} AS range_too_small_flag, {flag_sql('pre_close < 0.1')} AS tiny_preclose_flag,
    {flag_sql('open < 0.1')} AS tiny_open_flag,
    {div_sql('high - greatest(open, d.close)', 'high - low')} AS u_up, {div_sql('least(open, d.close) - low', 'high - low')} AS u_down
    FROM daily_bars d LEFT JOIN daily_basic b ON d.ts_code = b.ts_code AND d.trade_date = b.trade_date"""
_A2 = f"""SELECT ts_code, trade_date, {', '.join(f'CASE WHEN valid THEN u_{m} END AS {m}_raw, {m}_robust' for m in _A_MASKED)},
    CASE WHEN valid AND range_too_small_flag = 0 THEN u_up END AS upper_shadow_ratio_raw,
    CASE WHEN valid AND range_too_small_flag = 0 THEN u_down END AS lower_shadow_ratio_raw,
    turnover_rate_f / 100 AS turnover_free_raw, CASE WHEN turnover_rate_f > 0 THEN ln(1 + turnover_rate_f / 100) END AS turnover_free_log,
    volume_ratio AS volume_ratio_raw, CASE WHEN volume_ratio > 0 THEN ln(1 + volume_ratio) END AS volume_ratio_ln,
    {', '.join(f'''{flag_sql(f'abs(u_{m}) > 0.25')} AS {m}_market_extreme_flag, {flag_sql(f'abs(u_{m}) > 0.5')} AS {m}_likely_dirty_flag,
    greatest({flag_sql(f'abs(u_{m}) > 0.25')}, {t}) AS {m}_suspect_flag''' for m, t in (('ret_cc_1d', 'tiny_preclose_flag'), ('ret_oc_1d', 'tiny_open_flag')))},
    {flag_sql('NOT valid')} AS ohlc_invalid_flag, tiny_preclose_flag, tiny_open_flag, range_too_small_flag FROM a1"""


def _split(feature_set: str) -> tuple[list[str], list[str]]:
    cols = dom.FEATURES[feature_set][2:]
    whole = {"chip_cost_monotonic_ok", "chip_cost_any_missing"}
    flags = [c for c in cols if c.endswith("_flag") or c in whole]
    return [c for c in cols if c not in flags], flags


A_STEPS = {"a0": _A0, **sigma_ctes("a0", {f"{m}_robust": f"u_{m}" for m in _A_MASKED}, "a1"), "a2": _A2}
_da, _fa = _split("price_volume")


@query("domain_price_volume", with_views(["daily_bars", "daily_basic"], r_sql(_da, "a2", [*KEYS, *_fa]), **A_STEPS))
def domain_price_volume(v):
    return dom.price_volume(v.daily_bars(), v.daily_basic()).select(*dom.FEATURES["price_volume"])


# ------------------------------------------------------------------ B: money flow
_LEGS = [f"{s}_{z}_amount" for z in dom.LEGS for s in ("buy", "sell")]
B_START = "1996-01-01"
_B0 = f"""SELECT d.ts_code, d.trade_date, amount, {', '.join(f'10 * {x} AS {x}' for x in _LEGS)}, 10 * net_mf_amount AS net
    FROM daily_bars d LEFT JOIN moneyflow m ON d.ts_code = m.ts_code AND d.trade_date = m.trade_date WHERE d.trade_date >= DATE '{B_START}'"""
_B1 = f"""SELECT *, {', '.join(f'buy_{z}_amount + sell_{z}_amount AS tot_{z}' for z in dom.LEGS)}, buy_lg_amount + buy_elg_amount AS lb, sell_lg_amount + sell_elg_amount AS ls FROM b0"""
_B2 = f"""SELECT ts_code, trade_date, {flag_sql('amount <= 0')} AS amount_nonpositive_flag,
    {', '.join(f'''{flag_sql(x + ' IS NULL')} AS {x}_missing_flag, {flag_sql(x + ' = 0')} AS {x}_zero_flag,
    {flag_sql(f'amount > 0 AND {x} = 0')} AS {x}_no_activity_but_traded_flag''' for x in _LEGS)},
    {', '.join(f'''{div_sql(f'buy_{z}_amount - sell_{z}_amount', f'tot_{z}')} AS imb_{z}_amt_raw,
    CASE WHEN tot_{z} <> 0 THEN {div_sql(f'buy_{z}_amount - sell_{z}_amount', f'tot_{z}')} END AS imb_{z}_amt_valid,
    {flag_sql(f'buy_{z}_amount IS NULL OR sell_{z}_amount IS NULL')} AS imb_{z}_amt_missing_input_flag,
    {flag_sql(f'tot_{z} = 0')} AS imb_{z}_amt_den_zero_flag, {flag_sql(f'tot_{z} > 0 AND tot_{z} < 100')} AS imb_{z}_amt_micro_den_flag,
    {flag_sql(f'tot_{z} >= 100 AND tot_{z} < 1000')} AS imb_{z}_amt_small_den_flag''' for z in dom.LEGS)},
    {div_sql('net', 'amount')} AS net_mf_to_amount_raw, CASE WHEN amount > 0 THEN {div_sql('net', 'amount')} END AS net_mf_to_amount_valid,
    {div_sql('lb', 'amount')} AS large_buy_share_raw, {flag_sql(f"({div_sql('lb', 'amount')}) NOT BETWEEN -0.01 AND 1.01")} AS large_buy_share_out_of_domain_flag,
    {div_sql('ls', 'amount')} AS large_sell_share_raw, {flag_sql(f"({div_sql('ls', 'amount')}) NOT BETWEEN -0.01 AND 1.01")} AS large_sell_share_out_of_domain_flag,
    CASE WHEN amount > 0 AND lb / amount BETWEEN -0.01 AND 1.01 THEN least(greatest(lb / amount, 0), 1) END AS large_buy_share_valid,
    CASE WHEN amount > 0 AND ls / amount BETWEEN -0.01 AND 1.01 THEN least(greatest(ls / amount, 0), 1) END AS large_sell_share_valid,
    {div_sql('lb - ls', 'amount')} AS flow_divergence_raw, CASE WHEN amount > 0 THEN {div_sql('lb - ls', 'amount')} END AS flow_divergence_valid FROM b1"""
B_STEPS = {"b0": _B0, "b1": _B1, "b2": _B2, **sigma_ctes("b2", {"net_mf_to_amount_robust": "net_mf_to_amount_valid"}, "b3")}
_B_EXTRA = [f"{x}_{k}_flag" for x in _LEGS for k in ("missing", "zero", "no_activity_but_traded")]
_B_RAW = [*[f"imb_{z}_amt_raw" for z in dom.LEGS], "net_mf_to_amount_raw", "large_buy_share_raw", "large_sell_share_raw", "flow_divergence_raw"]
_db, _fb = _split("moneyflow")


@query("domain_moneyflow", with_views(["daily_bars", "moneyflow"], r_sql([*_db, *_B_RAW], "b3", [*KEYS, *_fb, *_B_EXTRA]), **B_STEPS))
def domain_moneyflow(v):
    return dom.moneyflow(v.daily_bars(), v.moneyflow(), B_START).select(*dom.FEATURES["moneyflow"], *_B_RAW, *_B_EXTRA)


# ------------------------------------------------------------------ C: cost distribution
C_START = "1996-01-01"
_C0 = f"""SELECT d.ts_code, d.trade_date, d.close, cost_5pct AS c5, cost_15pct AS c15, cost_50pct AS c50, cost_85pct AS c85, cost_95pct AS c95,
    weight_avg, winner_rate AS wr, his_low AS lo, his_high AS hi
    FROM daily_bars d LEFT JOIN cost_distribution c ON d.ts_code = c.ts_code AND d.trade_date = c.trade_date WHERE d.trade_date >= DATE '{C_START}'"""
_C1 = f"""SELECT *, c5 IS NULL OR c15 IS NULL OR c50 IS NULL OR c85 IS NULL OR c95 IS NULL AS miss,
    coalesce(c5 <= 0, FALSE) OR coalesce(c15 <= 0, FALSE) OR coalesce(c50 <= 0, FALSE) OR coalesce(c85 <= 0, FALSE) OR coalesce(c95 <= 0, FALSE) AS nonpos,
    coalesce(c5 <= c15 AND c15 <= c50 AND c50 <= c85 AND c85 <= c95, FALSE) AS mono, {div_sql('close - lo', 'hi - lo')} AS pos FROM c0"""
_C2 = f"""SELECT ts_code, trade_date, {flag_sql('miss')} AS chip_cost_any_missing, {flag_sql('nonpos')} AS chip_cost_nonpositive_flag,
    {flag_sql('mono')} AS chip_cost_monotonic_ok, {flag_sql('wr NOT BETWEEN 0 AND 100')} AS winner_rate_out_of_domain_flag,
    wr / 100 AS winner_rate_pct_raw, CASE WHEN wr IS NOT NULL THEN least(greatest(wr, 0), 100) END / 100 AS winner_rate_pct_capped,
    {flag_sql('hi = lo')} AS hist_range_zero_flag, {flag_sql('hi - lo < 0.01')} AS hist_range_small_flag, {flag_sql('lo <= 0')} AS his_low_nonpositive_flag,
    {flag_sql('pos NOT BETWEEN -0.01 AND 1.01')} AS price_pos_hist_out_of_domain_flag,
    CASE WHEN NOT coalesce(hi = lo, FALSE) AND NOT coalesce(hi - lo < 0.01, FALSE) AND NOT coalesce(pos NOT BETWEEN -0.01 AND 1.01, FALSE) THEN pos END AS price_pos_hist_valid,
    {flag_sql('NOT (NOT miss AND NOT nonpos AND mono)')} AS close_vs_cost50_den_invalid_flag,
    CASE WHEN NOT miss AND NOT nonpos AND mono THEN {div_sql('close - c50', 'c50')} END AS close_vs_cost50_valid,
    CASE WHEN NOT miss AND NOT nonpos AND mono THEN {div_sql('c95 - c5', 'c50')} END AS chip_width_95_5_valid,
    CASE WHEN NOT miss AND NOT nonpos AND mono THEN {div_sql('c85 - c15', 'c50')} END AS chip_width_85_15_valid,
    CASE WHEN NOT miss AND NOT nonpos AND mono THEN {div_sql('c95 - close', 'close')} END AS overhang_95_valid,
    CASE WHEN NOT miss AND NOT nonpos AND mono THEN {div_sql('close - c5', 'close')} END AS support_5_valid,
    CASE WHEN weight_avg > 0 THEN {div_sql('close - weight_avg', 'weight_avg')} END AS close_vs_weight_avg_valid FROM c1"""
_C4 = f"""SELECT *, {flag_sql('abs(close_vs_cost50_valid) > 3')} AS close_vs_cost50_extreme_flag, {flag_sql('chip_width_95_5_valid > 5')} AS chip_width_extreme_flag,
    {flag_sql('abs(overhang_95_valid) > 3')} AS overhang_95_outlier_flag, {flag_sql('abs(support_5_valid) > 3')} AS support_5_outlier_flag FROM c3"""
C_STEPS = {"c0": _C0, "c1": _C1, "c2": _C2,
           **sigma_ctes("c2", {"close_vs_cost50_robust": "close_vs_cost50_valid", "close_vs_weight_avg_robust": "close_vs_weight_avg_valid"}, "c3"), "c4": _C4}
_dc, _fc = _split("cost")


@query("domain_cost_distribution", with_views(["daily_bars", "cost_distribution"], r_sql(_dc, "c4", [*KEYS, *_fc]), **C_STEPS))
def domain_cost(v):
    v = v.staged(daily_bars=["ts_code", "trade_date", "close", "high", "low"])
    return dom.cost(v.daily_bars(), v.cost_distribution(), C_START, only=dom.FEATURES["cost"])


# ------------------------------------------------------------------ D: fundamentals
_D0 = """SELECT d.ts_code, d.trade_date, pe_ttm, pb, ps_ttm, dv_ttm, total_share, free_share, total_mv, circ_mv
    FROM daily_bars d LEFT JOIN daily_basic b ON d.ts_code = b.ts_code AND d.trade_date = b.trade_date"""
_D1 = f"""SELECT *, {', '.join(f'CASE WHEN {m} > 0 THEN ln(1 + {m}) END AS {m}_log, {flag_sql(m + ' > 0')} AS {m}_valid_flag' for m in ('pe_ttm', 'pb', 'ps_ttm'))},
    dv_ttm AS dv_ttm_raw, {', '.join(f'ln(1 + greatest({s}, 0)) AS {s}_log' for s in ('total_share', 'free_share', 'total_mv', 'circ_mv'))},
    least(greatest(free_share / (total_share + 1e-8), 0), 1) AS free_float_ratio_capped, least(greatest(circ_mv / (total_mv + 1e-8), 0), 1) AS circ_mv_to_total_mv_capped,
    {flag_sql('circ_mv / (total_mv + 1e-8) > 1')} AS circ_mv_to_total_mv_out_of_domain_flag, {flag_sql('pb > 100')} AS pb_extreme_flag,
    {flag_sql('ps_ttm > 1000')} AS ps_ttm_super_extreme_flag, {flag_sql('dv_ttm IS NULL')} AS dv_ttm_missing_flag, {flag_sql('dv_ttm = 0')} AS dv_ttm_zero_flag,
    {avg_rank_sql('pe_ttm', 'trade_date', 'pe_ttm_rank_mkt')}, {avg_rank_sql('pe_ttm', 'trade_date', 'pe_ttm_rank_ind')}, {avg_rank_sql('pb', 'trade_date', 'pb_rank_ind')},
    {avg_rank_sql('ps_ttm', 'trade_date', 'ps_ttm_rank_ind')}, {avg_rank_sql('dv_ttm', 'trade_date', 'dv_ttm_rank_mkt')}, {avg_rank_sql('total_mv', 'trade_date', 'mv_rank_mkt')} FROM d0"""
_D2 = "SELECT *, -0.4 * pe_ttm_rank_ind - 0.4 * pb_rank_ind - 0.2 * ps_ttm_rank_ind AS valuation_compress_score FROM d1"
D_STEPS = {"d0": _D0, "d1": _D1, "d2": _D2}
_dd, _fd = _split("fundamental")
_D_SQL = with_views(["daily_bars", "daily_basic"], r_sql(_dd, "d2", [*KEYS, *_fd]), **D_STEPS)


@query("domain_fundamental", _D_SQL)
def domain_fundamental(v):
    return dom.fundamental(v.daily_bars(), v.daily_basic(), width=v.width).select(*dom.FEATURES["fundamental"])


@query("domain_fundamental_split", _D_SQL)
def domain_fundamental_split(v):
    return dom.fundamental(v.daily_bars(), v.daily_basic(), plan="split").select(*dom.FEATURES["fundamental"])


# ------------------------------------------------------------------ E: intraday summary
_E0 = """SELECT ts_code, t AS trade_time, CAST(t AS DATE) AS trade_date, hour(t) AS hr, open, high, low, close, abs(vol) AS vol, abs(amount) AS amount,
    CASE WHEN abs(open) >= 0.05 THEN close / open - 1 END AS ret_h, row_number() OVER (PARTITION BY ts_code, CAST(t AS DATE) ORDER BY t) - 1 AS ix
    FROM (SELECT *, strptime(trade_time, '%Y-%m-%d %H:%M:%S') AS t FROM bars_60m)"""
_E1 = """SELECT ts_code, trade_date, first(open ORDER BY trade_time) AS o, last(close ORDER BY trade_time) AS c, max(high) AS h, min(low) AS l,
    sum(vol) AS vol_total, sum(amount) AS amount_total, coalesce(sum(abs(ret_h)), 0) AS path, stddev_samp(ret_h) AS vola,
    first(open ORDER BY trade_time) FILTER (WHERE hr <= 10) AS h1o, last(close ORDER BY trade_time) FILTER (WHERE hr <= 10) AS h1c,
    coalesce(sum(vol) FILTER (WHERE hr <= 10), 0) AS h1v, count(*) FILTER (WHERE hr <= 10) AS h1n,
    first(open ORDER BY trade_time) FILTER (WHERE hr = 15) AS lo, last(close ORDER BY trade_time) FILTER (WHERE hr = 15) AS lc,
    coalesce(sum(vol) FILTER (WHERE hr >= 13), 0) AS vol_pm, first(ix ORDER BY high DESC, ix) AS hix, first(ix ORDER BY low, ix) AS lix, count(*) AS n
    FROM e0 GROUP BY 1, 2"""
_E2 = "SELECT *, o <= 0 OR c <= 0 OR h <= 0 OR l <= 0 AS bad, NOT (o <= 0 OR c <= 0 OR h <= 0 OR l <= 0) AND n >= 2 AS ok, CASE WHEN vol_total >= 1 THEN amount_total / vol_total END AS vwap FROM e1"
_E3 = f"""SELECT ts_code, trade_date, CAST(bad AS INTEGER) AS day_price_nonpositive_flag, CAST(vol_total = 0 AND n >= 1 AS INTEGER) AS no_trade_day_flag,
    0 AS missing_intraday_source_flag, CAST(n >= 2 AND path = 0 AS INTEGER) AS sum_abs_ret_zero_flag, CAST(n < 2 AS INTEGER) AS low_bar_count_flag,
    CASE WHEN ok AND h1v > 0 AND h1o > 0.05 AND h1c > 0.05 THEN h1c / h1o - 1 END AS hour1_ret, CAST(NOT h1v > 0 AS INTEGER) AS hour1_has_trade_zero_flag,
    CAST(h1n = 1 AS INTEGER) AS hour1_single_trade_flag, CASE WHEN ok AND lo > 0.05 AND lc > 0.05 THEN lc / lo - 1 END AS lasthour_ret,
    CAST(path < 1e-3 AS INTEGER) AS intraday_trend_eff_den_small_flag, CASE WHEN ok THEN {div_sql('c - o', 'path', '1e-5')} END AS intraday_trend_eff,
    CASE WHEN ok AND vol_total >= 1 THEN least(greatest(vol_pm / vol_total, 0), 1) END AS volume_concentration_pm,
    CASE WHEN ok THEN (c - vwap) / greatest(vwap, c, 0.05) END AS vwap_close_bias_1h,
    CASE WHEN ok THEN least(greatest(CAST(hix - lix AS DOUBLE) / (n - 1), -1), 1) END AS high_low_time_skew, CASE WHEN ok THEN vola END AS hourly_volatility FROM e2"""
_E4 = "SELECT *, lasthour_ret - hour1_ret AS midday_reversal FROM e3"
E_STEPS = {"e0": _E0, "e1": _E1, "e2": _E2, "e3": _E3, "e4": _E4, **sigma_ctes("e4", {"intraday_trend_eff_robust": "intraday_trend_eff"}, "e5")}
_de, _fe = _split("intraday")


@query("domain_intraday", with_views(["bars_60m"], r_sql(_de, "e5", [*KEYS, *_fe]), **E_STEPS))
def domain_intraday(v):
    return dom.intraday(v.bars_60m(), only=dom.FEATURES["intraday"])


_E_AGG = {"open_day": "o", "close_day": "c", "high_day": "h", "low_day": "l", "vol_total": "vol_total", "amount_total": "amount_total", "sum_abs_ret": "path",
          "hourly_volatility": "vola", "hour1_open": "h1o", "hour1_close": "h1c", "hour1_vol": "h1v", "lasthour_open": "lo", "lasthour_close": "lc", "vol_pm": "vol_pm"}


@query("intraday_daily_aggregates", with_views(
    ["bars_60m"], r_sql(list(_E_AGG), "x", [*KEYS, "hour1_bar_count", "high_time_idx", "low_time_idx", '"count"']),
    e0=_E0, e1=_E1, x="SELECT ts_code, trade_date, h1n AS hour1_bar_count, hix AS high_time_idx, lix AS low_time_idx, n AS \"count\", "
    + ", ".join(f"{s} AS {o}" for o, s in _E_AGG.items()) + " FROM e1"))
def intraday_daily_aggregates(v):
    return dom.daily_from_bars(dom.clean_bars(v.bars_60m()))


# ------------------------------------------------------------------ panel and registry
PANEL_STEPS = {**A_STEPS, **B_STEPS, **C_STEPS, **E_STEPS, **D_STEPS}
_PANEL_D = [*_da, *_db, *_dc, *_de, *_dd]
_PANEL_F = [*_fa, *_fb, *_fc, *_fe, *_fd]
_PANEL = ("SELECT a2.ts_code, a2.trade_date, " + ", ".join(f"{t}.{c}" for t, cs in (("a2", _da + _fa), ("b3", _db + _fb), ("c4", _dc + _fc), ("e5", _de + _fe), ("d2", _dd + _fd)) for c in cs)
          + " FROM a2 " + " ".join(f"LEFT JOIN {t} ON a2.ts_code = {t}.ts_code AND a2.trade_date = {t}.trade_date" for t in ("b3", "c4", "e5", "d2")))


#: The tables of the panel that all_domains stores in the panel's buckets.
PLACED = ("price", "flow", "cost", "intraday")


def all_domains(v):
    how = lambda name: {"only": dom.FEATURES[name], "store": dom.panel_store}
    return {
        "price": dom.price_volume(v.daily_bars(), v.daily_basic(), **how("price_volume")),
        "flow": dom.moneyflow(v.daily_bars(), v.moneyflow(), B_START, **how("moneyflow")),
        "cost": dom.cost(v.daily_bars(), v.cost_distribution(), C_START, **how("cost")),
        "intraday": dom.intraday(v.bars_60m(), **how("intraday")),
        "fundamental": dom.fundamental(v.daily_bars(), v.daily_basic(), width=v.width).select(*dom.FEATURES["fundamental"]),
    }


def _staged(v):
    return v.staged("daily_bars", "daily_basic", store=dom.panel_store)


@query("model_panel", with_views(["daily_bars", "daily_basic", "moneyflow", "cost_distribution", "bars_60m"],
                                 r_sql(_PANEL_D, "panel", [*KEYS, *_PANEL_F]), **PANEL_STEPS, panel=_PANEL))
def model_panel(v):
    return dom.model_panel(placed=PLACED, **all_domains(_staged(v)))


@query("model_panel_colocated", ORACLES["model_panel"])
def model_panel_colocated(v):
    """The same panel from bucketed tables, joined without a shuffle."""
    return dom.model_panel(colocate=True, placed=PLACED, **all_domains(_staged(v)))


_SELECTED = selected_features("allow_in_search", ["price_volume"])


@query("registry_selected_features", with_views(["daily_bars", "daily_basic"], r_sql(_SELECTED, "a2", KEYS), **A_STEPS))
def registry_selected_features(v):
    """Columns the registry admits to factor search, cut from the price table."""
    table = dom.price_volume(v.daily_bars(), v.daily_basic())
    return table.select("ts_code", "trade_date", *_SELECTED)


#: Every registered feature with its policies, and the valuation column that stands in for it; rounded values make ties.
_POL = {r["feature_name"]: (r["fill_policy"], r["clip_policy"]) for r in feature_registry_rows()}
_STAND_IN = {f: ("pb / 7", "floor(pe_ttm * 100) / 700", "ps_ttm / 7", "volume_ratio / 7", "(dv_ttm - 1) / 7", "turnover_rate_f / 700")[i % 6] for i, f in enumerate(_POL)}
_BETWEEN = "CASE WHEN {x} IS NOT NULL THEN least(greatest({x}, {lo}), {hi}) END"


def _filled(f: str) -> str:
    how, x = _POL[f][0], f"s.{f}"
    return {
        "zero": f"coalesce({x}, 0)", "industry_median": f"coalesce({x}, {f}_m)", "clip_0_1": _BETWEEN.format(x=x, lo=0, hi=1),
        "ffill_1d_if_single_gap": f"last_value({x} IGNORE NULLS) OVER (PARTITION BY s.ts_code ORDER BY s.trade_date ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)",
    }.get(how, x)


def _clipped(f: str) -> str:
    lo, hi = {"clip_1_99": (f"{f}_lo", f"{f}_hi"), "clip_0_1_robust": (0, 1), "clip_20": (-20, 20)}.get(_POL[f][1], (None, None))
    return f"f.{f}" if lo is None else _BETWEEN.format(x=f"f.{f}", lo=lo, hi=hi)


_MEDIANS, _CUTS = [f for f in _POL if _POL[f][0] == "industry_median"], [f for f in _POL if _POL[f][1] == "clip_1_99"]
_POL_SQL = with_views(
    ["daily_basic", "industry_static"], r_sql(list(_POL), "t", KEYS),
    s=f"SELECT b.ts_code, b.trade_date, l1_name, {', '.join(f'{x} AS {f}' for f, x in _STAND_IN.items())} FROM daily_basic b JOIN industry_static i ON b.ts_code = i.ts_code",
    m=f"SELECT trade_date, l1_name, {', '.join(f'median({f}) AS {f}_m' for f in _MEDIANS)} FROM s GROUP BY 1, 2",
    f=f"SELECT s.ts_code, s.trade_date, {', '.join(f'{_filled(f)} AS {f}' for f in _POL)} FROM s JOIN m ON s.trade_date = m.trade_date AND s.l1_name = m.l1_name",
    q=f"SELECT trade_date, {', '.join(f'quantile_cont({f}, 0.01) AS {f}_lo, quantile_cont({f}, 0.99) AS {f}_hi' for f in _CUTS)} FROM f GROUP BY 1",
    t=f"SELECT f.ts_code, f.trade_date, {', '.join(f'{_clipped(f)} AS {f}' for f in _POL)} FROM f JOIN q ON f.trade_date = q.trade_date",
)


def _policies(v, **how):
    """All registered features under their policies, on stand-in columns."""
    df = v.daily_basic().join(v.industry_static().select("ts_code", "l1_name"), "ts_code")
    df = df.selectExpr("ts_code", "trade_date", "l1_name", *[f"{x} AS {f}" for f, x in _STAND_IN.items()])
    return apply_policies(df, {f: f for f in _POL}, **how).drop("l1_name")


@query("registry_policies", _POL_SQL)
def registry_policies(v):
    return _policies(v, width=v.width)


@query("registry_policies_split", _POL_SQL)
def registry_policies_split(v):
    return _policies(v, plan="split")


_IND_RANKS = ["pe_ttm_rank_mkt", "pe_ttm_rank_ind", "pb_rank_ind", "valuation_compress_score"]


@query("fundamental_true_industry_ranks", with_views(["daily_basic", "industry_static"], r_sql(_IND_RANKS, "s", KEYS), i="SELECT b.*, l1_name FROM daily_basic b JOIN industry_static i ON b.ts_code = i.ts_code",
    r=f"SELECT *, {avg_rank_sql('pe_ttm', 'trade_date', 'pe_ttm_rank_mkt')}, {avg_rank_sql('pe_ttm', 'trade_date, l1_name', 'pe_ttm_rank_ind')}, {avg_rank_sql('pb', 'trade_date, l1_name', 'pb_rank_ind')}, {avg_rank_sql('ps_ttm', 'trade_date, l1_name', 'ps_ttm_rank_ind')} FROM i",
    s="SELECT *, -0.4 * pe_ttm_rank_ind - 0.4 * pb_rank_ind - 0.2 * ps_ttm_rank_ind AS valuation_compress_score FROM r"))
def fundamental_true_industry_ranks(v):
    """Option of the fundamental table: ranks inside a real industry column."""
    basic = v.daily_basic().join(v.industry_static().select("ts_code", "l1_name"), "ts_code")
    return dom.fundamental(v.daily_bars(), basic, width=v.width, industry="l1_name").select("ts_code", "trade_date", *_IND_RANKS)
