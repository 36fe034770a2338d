"""Point-in-time joins and the factor library."""

from __future__ import annotations

from suite.common import query
from suite.view_sql import rounded as r_sql
from suite.view_sql import with_views
from tidepanel.plans import factors as fac
from tidepanel.sources.star_views import FINANCIAL_COLUMNS

YMD = "strftime(trade_date, '%Y%m%d') AS trade_date"
KEYS = ["ts_code", YMD]

PIT = """SELECT b.*, coalesce(i.l1_name, 'Unknown') AS l1_name, coalesce(i.l2_name, 'Unknown') AS l2_name, coalesce(i.l3_name, 'Unknown') AS l3_name
    FROM daily_basic b ASOF JOIN industry_iv i ON b.ts_code = i.ts_code AND b.trade_date >= i.in_date WHERE b.trade_date < i.out_date"""
FULL = f"""SELECT p.*, {', '.join('f.' + c for c in FINANCIAL_COLUMNS)}, f.ann_date
    FROM pit p ASOF LEFT JOIN fina f ON p.ts_code = f.ts_code AND p.trade_date >= f.ann_date"""


def rank_sql(x: str, level: str, out: str, desc: bool = False) -> str:
    key = f"-{x}" if desc else x
    return (f"CASE WHEN {x} IS NOT NULL THEN row_number() OVER (PARTITION BY trade_date, {level} ORDER BY {key} ASC NULLS LAST, ts_code)"
            f" / count({x}) OVER (PARTITION BY trade_date, {level}) END AS {out}")


BASE = """SELECT *, 1.0 / nullif(pe_ttm, 0) AS ep_ttm, 1.0 / nullif(pb, 0) AS bp, 1.0 / nullif(ps_ttm, 0) AS sp_ttm, dv_ttm / 100 AS div_ttm_val,
    ln(1 + turnover_rate_f) AS turn_f, ln(1 + volume_ratio) AS vol_ratio, ln(circ_mv) AS log_size, free_share / nullif(float_share, 0) AS ff_ratio FROM {src}"""


def z20_sql(x: str, out: str, k: int = 20, need: str = "= 20") -> str:
    w = f"OVER (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    return (f"CASE WHEN count({x}) {w} {need} AND max({x}) {w} > min({x}) {w} "
            f"THEN ({x} - avg({x}) {w}) / stddev_samp({x}) {w} END AS {out}")


WC = "OVER (PARTITION BY ts_code ORDER BY trade_date)"
HIST = f"""SELECT *, lag(ep_ttm, 1) {WC} AS ep_ttm_lag1, lag(ep_ttm, 5) {WC} AS ep_ttm_lag5, lag(ep_ttm, 20) {WC} AS ep_ttm_lag20,
    ep_ttm / nullif(lag(ep_ttm, 20) {WC}, 0) - 1 AS ep_ttm_chg20, turn_f / nullif(lag(turn_f, 5) {WC}, 0) - 1 AS turn_f_chg5,
    pb / nullif(lag(pb, 20) {WC}, 0) - 1 AS pb_compress_20, pe_ttm / nullif(lag(pe_ttm, 20) {WC}, 0) - 1 AS pe_re_rate_20,
    {z20_sql('turn_f', 'turn_f_z20')}, {z20_sql('vol_ratio', 'vol_ratio_z20')} FROM base"""
DRANK = f"""SELECT *, {rank_sql('ep_ttm', 'l2_name', 'ep_ttm_rank_ind_l2')}, {rank_sql('bp', 'l2_name', 'bp_rank_ind_l2')},
    {rank_sql('turn_f', 'l2_name', 'turn_f_rank_ind_l2')}, {rank_sql('turn_f_chg5', 'l2_name', 'turn_f_chg5_ind_rank')},
    {rank_sql('pb_compress_20', 'l2_name', 'pb_compress_20_ind_rank')}, {rank_sql('div_ttm_val', 'l1_name', 'div_ttm_rank_ind_l1')} FROM hist"""
DFAC = """SELECT *, -(coalesce(turn_f_z20, 0) + coalesce(vol_ratio_z20, 0)) AS anti_crowding, bp_rank_ind_l2 - turn_f_rank_ind_l2 AS value_recovery FROM drank"""
_RANKED = [*fac.HIGHER_IS_BETTER, *fac.LOWER_IS_BETTER, "tr_yoy", "profit_to_gr"]
QRANK = (f"SELECT *, {', '.join(rank_sql(m, 'l2_name', m + '_ind_rank', m in fac.LOWER_IS_BETTER) for m in _RANKED)} "
         "FROM (SELECT *, coalesce(ebitda / nullif(interestdebt, 0), 0) AS ebitda_to_debt FROM dfac)")
QFAC = """SELECT *, (coalesce(tr_yoy_ind_rank, 0) + coalesce(dt_netprofit_yoy_ind_rank, 0)) / 2 AS growth_consistency_ind_rank FROM qrank"""
CRANK = f"SELECT *, {rank_sql('turn_f_z20', 'l2_name', 'turn_f_z20_ind_rank')}, {rank_sql('vol_ratio_z20', 'l2_name', 'vol_ratio_z20_ind_rank')} FROM qfac"
COMP = """SELECT *,
    0.35 * coalesce(ep_ttm_rank_ind_l2, 0) + 0.25 * coalesce(bp_rank_ind_l2, 0) + 0.20 * coalesce(roe_dt_ind_rank, 0) + 0.20 * coalesce(q_ocf_to_sales_ind_rank, 0) AS comp_value_quality,
    0.25 * profit_to_gr_ind_rank + 0.25 * coalesce(q_ocf_to_sales_ind_rank, 0) + 0.25 * coalesce(q_op_qoq_ind_rank, 0) + 0.25 * coalesce(dt_netprofit_yoy_ind_rank, 0) AS comp_margin_improvement,
    0.40 * coalesce(bp_rank_ind_l2, 0) + 0.30 * coalesce(div_ttm_rank_ind_l1, 0) - 0.15 * coalesce(turn_f_z20_ind_rank, 0) - 0.15 * coalesce(vol_ratio_z20_ind_rank, 0) AS comp_anti_crowded_val,
    0.30 * coalesce(assets_turn_ind_rank, 0) + 0.20 * coalesce(ar_turn_ind_rank, 0) + 0.20 * coalesce(turn_days_ind_rank, 0) + 0.30 * coalesce(dt_netprofit_yoy_ind_rank, 0) AS comp_efficiency_growth,
    0.25 * coalesce(current_ratio_ind_rank, 0) + 0.25 * coalesce(ocf_to_debt_ind_rank, 0) + 0.25 * coalesce(ebitda_to_debt_ind_rank, 0) + 0.25 * coalesce(debt_to_assets_ind_rank, 0) AS comp_quality_safety
    FROM crank"""


def neutral_ctes(y: str, out: str, src: str, size: str | None, industry: str | None, prefix: str = "n") -> dict[str, str]:
    """Residuals as SQL: clip, demean inside the industry, one slope per date."""
    ok = f"{y} IS NOT NULL" + (f" AND {size} IS NOT NULL" if size else "") + (f" AND {industry} IS NOT NULL" if industry else "")
    s = size or "0.0"
    part = f"trade_date, {industry}" if industry else "trade_date"
    return {
        f"{prefix}0": f"SELECT *, ({ok}) AS _ok, CASE WHEN {ok} THEN {y} END AS _y0, CASE WHEN {ok} THEN {s} END AS _s0 FROM {src}",
        f"{prefix}q": f"""SELECT trade_date, quantile_cont(_y0, 0.02) AS yl, quantile_cont(_y0, 0.98) AS yh, quantile_cont(_s0, 0.02) AS sl,
            quantile_cont(_s0, 0.98) AS sh, count(_y0) AS nv FROM {prefix}0 GROUP BY trade_date""",
        f"{prefix}1": f"""SELECT t.*, nv, CASE WHEN _ok THEN least(greatest(_y0, yl), yh) END AS _y, CASE WHEN _ok THEN least(greatest(_s0, sl), sh) END AS _s
            FROM {prefix}0 t JOIN {prefix}q q ON t.trade_date = q.trade_date""",
        f"{prefix}2": f"""SELECT *, _y - avg(_y) OVER (PARTITION BY {part}) AS _yt, _s - avg(_s) OVER (PARTITION BY {part}) AS _st FROM {prefix}1""",
        f"{prefix}b": f"SELECT trade_date, CASE WHEN max(abs(_st)) < 1e-12 THEN 0 ELSE coalesce(sum(_yt * _st) / nullif(sum(_st * _st), 0), 0) END AS beta FROM {prefix}2 GROUP BY trade_date",
        f"{prefix}": f"SELECT t.*, CASE WHEN _ok AND nv >= 30 THEN _yt - beta * _st END AS {out} FROM {prefix}2 t JOIN {prefix}b b ON t.trade_date = b.trade_date",
    }


DAILY_COLS = [
    "ep_ttm", "bp", "sp_ttm", "div_ttm_val", "turn_f", "vol_ratio", "log_size", "ff_ratio", "ep_ttm_lag1", "ep_ttm_lag5", "ep_ttm_lag20",
    "ep_ttm_chg20", "turn_f_chg5", "pb_compress_20", "pe_re_rate_20", "turn_f_z20", "vol_ratio_z20", "ep_ttm_rank_ind_l2", "bp_rank_ind_l2",
    "turn_f_rank_ind_l2", "turn_f_chg5_ind_rank", "pb_compress_20_ind_rank", "div_ttm_rank_ind_l1", "anti_crowding", "value_recovery",
]
REPORT_COLS = ["ebitda_to_debt", *[f"{m}_ind_rank" for m in [*fac.HIGHER_IS_BETTER, *fac.LOWER_IS_BETTER]], "growth_consistency_ind_rank"]
COMPOSITE_COLS = ["turn_f_z20_ind_rank", "vol_ratio_z20_ind_rank", *fac.COMPOSITES]

STEPS = {"pit": PIT, "joined": FULL, "base": BASE.format(src="joined"), "hist": HIST, "drank": DRANK, "dfac": DFAC, "qrank": QRANK, "qfac": QFAC, "crank": CRANK, "comp": COMP}
PIT_VIEWS = ["daily_basic", "industry_iv"]
FULL_VIEWS = [*PIT_VIEWS, "fina"]


def upto(last: str) -> dict[str, str]:
    names = list(STEPS)
    return {n: STEPS[n] for n in names[: names.index(last) + 1]}


def without_reports(last: str) -> dict[str, str]:
    steps = {**upto(last), "base": BASE.format(src="pit")}
    del steps["joined"]
    return steps


def pit_panel(v):
    return fac.point_in_time_panel(v.daily_basic(), v.industry_pit(), None)


def full_panel(v):
    """With the reported columns that the factors need; the others would travel through every join unread."""
    return fac.point_in_time_panel(v.daily_basic(), v.industry_pit(), v.fina_indicator(), fac.REPORTED, report_tie=["report_type"])


@query("value_recovery", with_views(PIT_VIEWS, r_sql(["ep_ttm", "bp", "turn_f_rank_ind_l2", "bp_rank_ind_l2", "value_recovery"], "dfac", [*KEYS, "l2_name"]),
                                    **{k: s for k, s in without_reports("dfac").items()}))
def value_recovery(v):
    df = fac.daily_factors(pit_panel(v), width=v.width, plan="auto")
    return df.select("ts_code", "trade_date", "l2_name", "ep_ttm", "bp", "turn_f_rank_ind_l2", "bp_rank_ind_l2", "value_recovery")


@query("daily_factors", with_views(PIT_VIEWS, r_sql(DAILY_COLS, "dfac", KEYS), **without_reports("dfac")))
def daily_factors(v):
    return fac.daily_factors(pit_panel(v), plan="auto", width=v.width).select("ts_code", "trade_date", *DAILY_COLS)


@query("reported_factors", with_views(FULL_VIEWS, r_sql(REPORT_COLS, "qfac", KEYS), **{**upto("joined"), "dfac": "SELECT * FROM joined", "qrank": QRANK, "qfac": QFAC}))
def reported_factors(v):
    return fac.reported_factors(full_panel(v), plan="auto", width=v.width).select("ts_code", "trade_date", *REPORT_COLS)


@query("factor_panel", with_views(FULL_VIEWS, r_sql([*DAILY_COLS, *REPORT_COLS, *COMPOSITE_COLS, "ep_ttm_neu"], "n", [*KEYS, "l1_name", "l2_name"]),
                                  **upto("comp"), **neutral_ctes("ep_ttm", "ep_ttm_neu", "comp", "ln(nullif(log_size, 0))", "l1_name")))
def factor_panel(v):
    df = fac.factor_panel(v.daily_basic(), v.industry_pit(), v.fina_indicator(), fac.REPORTED, v.width, ["report_type"])
    return df.select("ts_code", "trade_date", "l1_name", "l2_name", *DAILY_COLS, *REPORT_COLS, *COMPOSITE_COLS, "ep_ttm_neu")


def avg_rank_sql(x: str, part: str, out: str, guard: str = "TRUE") -> str:
    return (f"CASE WHEN {x} IS NOT NULL AND {guard} THEN (rank() OVER (PARTITION BY {part} ORDER BY {x} ASC NULLS LAST) "
            f"+ (count({x}) OVER (PARTITION BY {part}, {x}) - 1) / 2) / count({x}) OVER (PARTITION BY {part}) END AS {out}")


_GUARD = "count(*) OVER (PARTITION BY trade_date, l2_name) >= 5"


_CROWDING = {"turn_f_z20_ind_rank": "tz", "vol_ratio_z20_ind_rank": "vz"}
_KNOWN = {*DAILY_COLS, *REPORT_COLS, *[f"{m}_ind_rank" for m in ("tr_yoy", "profit_to_gr")]}


def _weighted(weights: dict[str, float]) -> str:
    """A term of an absent column is zero, a NULL one leaves the sum NULL."""
    return " + ".join(f"{w} * {_CROWDING.get(n, n if n in _KNOWN else '0')}" for n, w in weights.items())


_ALT = f"""SELECT ts_code, trade_date, {', '.join(f'{_weighted(w)} AS {n}' for n, w in fac.ALTERNATIVE_COMPOSITES.items())} FROM (
    SELECT *, {avg_rank_sql("turn_f_z20", "trade_date, l2_name", "tz", _GUARD)}, {avg_rank_sql("vol_ratio_z20", "trade_date, l2_name", "vz", _GUARD)} FROM qfac)"""


@query("alternative_composites", with_views(FULL_VIEWS, r_sql(list(fac.ALTERNATIVE_COMPOSITES), "alt", KEYS), **upto("qfac"), alt=_ALT))
def alternative_composites(v):
    """All five composites on the panel with reports."""
    df = fac.reported_factors(fac.daily_factors(full_panel(v), plan="auto", width=v.width), plan="auto", width=v.width)
    return fac.alternative_composites(df, width=v.width).select("ts_code", "trade_date", *fac.ALTERNATIVE_COMPOSITES)
