"""Factor evaluation and universe construction."""

from __future__ import annotations

from pyspark.sql import functions as F

from suite.common import query
from suite.factor_queries import BASE, KEYS, PIT, PIT_VIEWS, WC, avg_rank_sql, neutral_ctes, pit_panel, rank_sql
from suite.library_queries import bucket_sql, ymd
from suite.view_sql import rounded as r_sql
from suite.view_sql import with_views
from tidepanel.functions.scalars import ratio
from tidepanel.operators import cross_section as xs
from tidepanel.operators import evaluate as ev
from tidepanel.operators import universe as un
from tidepanel.operators.neutralize import neutralize
from tidepanel.plans import factors as fac

HORIZONS = (1, 5, 10, 20)

# ------------------------------------------------------------------ returns and information coefficients
RET = f"""SELECT *, {', '.join(f'lead(close, {k}) {WC} / nullif(close, 0) - 1 AS ret_{k}' for k in HORIZONS)},
    1.0 / nullif(pb, 0) AS bp FROM daily_basic"""
LONG = " UNION ALL ".join(f"SELECT ts_code, trade_date, bp, 'ret_{k}' AS horizon, ret_{k} AS ret FROM r" for k in HORIZONS)
_PART = "horizon, trade_date"
_CORR = "CASE WHEN max({x}) > min({x}) AND max({y}) > min({y}) THEN corr({x}, {y}) END"
IC = {"r": RET, "lg": LONG,
      "rk": f"SELECT *, {avg_rank_sql('bp', _PART, 'fr')}, {avg_rank_sql('ret', _PART, 'rr')} FROM (SELECT * FROM lg WHERE bp IS NOT NULL AND ret IS NOT NULL)",
      "ic": f"SELECT horizon, trade_date, {_CORR.format(x='bp', y='ret')} AS ic, {_CORR.format(x='fr', y='rr')} AS rank_ic, count(*) AS n_obs FROM rk GROUP BY 1, 2"}
GROUPS = {"bk": f"SELECT *, {bucket_sql('bp', _PART, 5, 'b')} FROM lg",
          "gr": "SELECT horizon, trade_date, " + ", ".join(f"avg(ret) FILTER (WHERE b = {g + 1}) AS group_{g}" for g in range(5)) + " FROM bk WHERE b IS NOT NULL GROUP BY 1, 2",
          "gl": "SELECT *, group_4 - group_0 AS long_short FROM gr"}
GCOLS = [*[f"group_{g}" for g in range(5)], "long_short"]


def with_returns(v):
    df = ev.forward_returns(v.daily_basic().select("ts_code", "trade_date", "close", "pb", "circ_mv", "turnover_rate_f"), horizons=HORIZONS)
    return df.withColumn("bp", ratio(F.lit(1.0), "pb"))


def _rets():
    return [f"ret_{k}" for k in HORIZONS]


@query("forward_returns", with_views(["daily_basic"], r_sql(_rets(), "r", KEYS), r=RET))
def forward_returns(v):
    return with_returns(v).select("ts_code", "trade_date", *_rets())


@query("information_coefficients", with_views(["daily_basic"], r_sql(["ic", "rank_ic"], "ic", ["horizon", ymd("trade_date"), "n_obs"]), **IC))
def information_coefficients(v):
    rows = ev.long_returns(with_returns(v), ["ts_code", "trade_date", "bp"], _rets())
    return ev.information_coefficients(rows, "bp", ["horizon", "trade_date"], width=len(HORIZONS) * v.width)


_SUM = [f"{c}_{k}" for c in ("ic", "rank_ic") for k in ("mean", "std", "ir", "positive_share")]
_SUMMARY = "SELECT {by}, " + ", ".join(
    f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_std, CASE WHEN stddev_samp({c}) = 0 THEN 0 ELSE avg({c}) / stddev_samp({c}) END AS {c}_ir, avg(CASE WHEN round({c}, 9) > 0 THEN 1 WHEN round({c}, 9) <= 0 THEN 0 END) AS {c}_positive_share" for c in ("ic", "rank_ic")
) + ", count(*) AS n_dates, CAST(sum(n_obs) AS BIGINT) AS n_obs FROM {src} GROUP BY {by}"


@query("ic_summary", with_views(["daily_basic"], r_sql(_SUM, "s", ["horizon", "n_dates", "n_obs"]), **IC, s=_SUMMARY.format(by="horizon", src="ic")))
def ic_summary(v):
    return ev.evaluate(with_returns(v), "bp", _rets(), width=len(HORIZONS) * v.width)[1]


@query("quantile_group_returns", with_views(["daily_basic"], r_sql(GCOLS, "gl", ["horizon", ymd("trade_date")]), r=RET, lg=LONG, **GROUPS))
def quantile_group_returns(v):
    rows = ev.long_returns(with_returns(v), ["ts_code", "trade_date", "bp"], _rets())
    return ev.quantile_returns(rows, "bp", ["horizon", "trade_date"], width=len(HORIZONS) * v.width)


_CUM = {**IC, **GROUPS, "sr": "SELECT i.horizon, i.trade_date, rank_ic, long_short AS ls FROM ic i JOIN gl g ON i.horizon = g.horizon AND i.trade_date = g.trade_date",
        "cs": """SELECT horizon, trade_date, CASE WHEN count(rank_ic) OVER w20 >= 20 THEN avg(rank_ic) OVER w20 END AS rank_ic_ma20, sum(rank_ic) OVER wc AS rank_ic_cumsum,
        sign(product(1 + ls) OVER wc) AS ls_nav_sign, ln(abs(nullif(product(1 + ls) OVER wc, 0))) AS ls_nav_log FROM sr WINDOW wc AS (PARTITION BY horizon ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
        w20 AS (PARTITION BY horizon ORDER BY trade_date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)"""}


def _series(v):
    series, _ = ev.evaluate(with_returns(v), "bp", _rets(), width=len(HORIZONS) * v.width)
    return series.where(F.col("rank_ic").isNotNull() | F.col("n_obs").isNotNull()).withColumn("ls", F.col("long_short"))


@query("cumulative_evaluation_series", with_views(["daily_basic"], r_sql(["rank_ic_ma20", "rank_ic_cumsum", "ls_nav_sign", "ls_nav_log"], "cs", ["horizon", ymd("trade_date")]), **_CUM))
def cumulative_evaluation_series(v):
    """The growth of a series that falls below -100 % changes sign and spans many powers of ten: told as sign and logarithm."""
    out = ev.cumulative_series(_series(v), ["horizon"], ["rank_ic"], ["ls"], {"rank_ic": 20})
    nav = [F.signum("ls_nav").alias("ls_nav_sign"), F.ln(F.abs(F.nullif("ls_nav", F.lit(0.0)))).alias("ls_nav_log")]
    return out.select("horizon", "trade_date", "rank_ic_ma20", "rank_ic_cumsum", *nav)


@query("long_short_performance", with_views(["daily_basic"], r_sql(["annual_return", "annual_volatility", "sharpe", "max_drawdown"], "p", ["horizon", "n_periods"]), **_CUM,
    nv="SELECT horizon, trade_date, ls, product(1 + ls) OVER (PARTITION BY horizon ORDER BY trade_date) AS nav FROM sr WHERE ls IS NOT NULL",
    dd="SELECT *, nav / greatest(max(nav) OVER (PARTITION BY horizon ORDER BY trade_date), 1) - 1 AS d FROM nv",
    p="SELECT horizon, avg(ls) * 52 AS annual_return, stddev_samp(ls) * sqrt(52) AS annual_volatility, avg(ls) / stddev_samp(ls) * sqrt(52) AS sharpe, min(d) AS max_drawdown, count(*) AS n_periods FROM dd GROUP BY 1"))
def long_short_performance(v):
    return ev.performance(_series(v), "ls", ["horizon"], periods=52)


@query("top_group_turnover", with_views(["daily_basic"], r_sql(["turnover", "coverage"], "t", [ymd("trade_date"), "n_rows"]), r=RET, b=f"SELECT *, {bucket_sql('bp', 'trade_date', 5, 'b')} FROM r",
    w=f"SELECT *, coalesce(b = 5, FALSE) AS top, coalesce(lag(coalesce(b = 5, FALSE)) {WC}, FALSE) AS was FROM b",
    t="SELECT trade_date, count(*) FILTER (WHERE top AND NOT was) / nullif(count(*) FILTER (WHERE top), 0) AS turnover, count(bp) / count(*) AS coverage, count(*) AS n_rows FROM w GROUP BY 1"))
def top_group_turnover(v):
    return ev.top_group_turnover(with_returns(v), "bp", width=v.width)


@query("top_decile_capacity", with_views(["daily_basic"], r_sql(["top_size", "top_activity"], "t", [ymd("trade_date"), "n_top"]), r=RET, b=f"SELECT *, {bucket_sql('bp', 'trade_date', 10, 'b')} FROM r",
    t="SELECT trade_date, avg(circ_mv) / 1e6 AS top_size, avg(turnover_rate_f) AS top_activity, count(*) AS n_top FROM b WHERE b = 10 GROUP BY 1"))
def top_decile_capacity(v):
    return ev.capacity(with_returns(v), "bp", "circ_mv", "turnover_rate_f", width=v.width).withColumn("top_size", F.col("top_size") / 1e6)


_SEG = {"r": RET, "s": f"SELECT r.*, year(trade_date) AS yr, l1_name, {bucket_sql('circ_mv', 'trade_date', 3, 'sz')} FROM r JOIN industry_static i ON r.ts_code = i.ts_code",
        "lg": " UNION ALL ".join(f"SELECT trade_date, bp, 'ret_{k}' AS horizon, ret_{k} AS ret, '{n}' AS dim, CAST({c} AS VARCHAR) AS seg FROM s" for k in HORIZONS for n, c in (("year", "yr"), ("size", "sz"), ("industry", "l1_name"))),
        "rk": f"SELECT *, {avg_rank_sql('bp', 'horizon, dim, seg, trade_date', 'fr')}, {avg_rank_sql('ret', 'horizon, dim, seg, trade_date', 'rr')} FROM (SELECT * FROM lg WHERE bp IS NOT NULL AND ret IS NOT NULL)",
        "ic": f"SELECT horizon, dim, seg, trade_date, {_CORR.format(x='bp', y='ret')} AS ic, {_CORR.format(x='fr', y='rr')} AS rank_ic, count(*) AS n_obs FROM rk GROUP BY 1, 2, 3, 4",
        "sm": _SUMMARY.format(by="horizon, dim, seg", src="ic")}


@query("ic_by_segment", with_views(["daily_basic", "industry_static"], r_sql(_SUM, "sm", ["horizon", "dim", "seg", "n_dates", "n_obs"]), **_SEG))
def ic_by_segment(v):
    """Decay over the horizons by year, size bucket and industry in one job: segments and horizons are rows, not loops."""
    df = with_returns(v).join(v.industry_static().select("ts_code", F.col("l1_name").alias("industry")), "ts_code")
    df = xs.add_bucket(df, "circ_mv", ["trade_date"], 3, "size", width=v.width, plan="auto")
    df = df.withColumns({"year": F.year("trade_date").cast("string"), "size": F.col("size").cast("string")})
    rows = ev.long_returns(df, ["ts_code", "trade_date", "bp", "year", "size", "industry"], _rets())
    rows = rows.unpivot(["ts_code", "trade_date", "bp", "horizon", "ret"], ["year", "size", "industry"], "dim", "seg")
    ics = ev.information_coefficients(rows, "bp", ["horizon", "dim", "seg", "trade_date"], width=v.width)
    return ev.ic_summary(ics, ["horizon", "dim", "seg"])


_VER = {"pit": PIT, "base": BASE.format(src="pit"),
        "rr": f"SELECT *, lead(close, 1) {WC} / nullif(close, 0) - 1 AS ret FROM base",
        "q": "SELECT trade_date, quantile_cont(bp, 0.02) AS lo, quantile_cont(bp, 0.98) AS hi FROM rr GROUP BY 1",
        "w": "SELECT rr.*, least(greatest(bp, lo), hi) AS bw FROM rr JOIN q ON rr.trade_date = q.trade_date",
        "z": f"SELECT *, CASE WHEN max(bw) OVER d > min(bw) OVER d THEN (bw - avg(bw) OVER d) / stddev_samp(bw) OVER d ELSE bw - avg(bw) OVER d END AS winsor_z, {rank_sql('bp', 'l2_name', 'industry_rank')} FROM w WINDOW d AS (PARTITION BY trade_date)",
        **neutral_ctes("bp", "neutral", "z", "ln(circ_mv)", "l1_name"),
        "lg": " UNION ALL ".join(f"SELECT trade_date, '{n}' AS version, {c} AS f, ret FROM n" for n, c in (("raw", "bp"), ("winsor_z", "winsor_z"), ("industry_rank", "industry_rank"), ("neutral", "neutral"))),
        "rk": f"SELECT *, {avg_rank_sql('f', 'version, trade_date', 'fr')}, {avg_rank_sql('ret', 'version, trade_date', 'rr')} FROM (SELECT * FROM lg WHERE f IS NOT NULL AND ret IS NOT NULL)",
        "ic": f"SELECT version, trade_date, {_CORR.format(x='f', y='ret')} AS ic, {_CORR.format(x='fr', y='rr')} AS rank_ic, count(*) AS n_obs FROM rk GROUP BY 1, 2",
        "sm": _SUMMARY.format(by="version", src="ic")}


@query("factor_version_comparison", with_views(PIT_VIEWS, r_sql(_SUM, "sm", ["version", "n_dates", "n_obs"], 4), **_VER), digits=4)
def factor_version_comparison(v):
    df = ev.forward_returns(fac.base_factors(pit_panel(v)), horizons=(1,)).withColumns({"raw": F.col("bp"), "winsor_z": F.col("bp")})
    df = xs.standardize(xs.winsorize(df, ["winsor_z"], ["trade_date"], width=v.width), ["winsor_z"], ["trade_date"])
    df = xs.add_ranks(df, {"industry_rank": "bp"}, ["trade_date", "l2_name"], ["ts_code"], "ts_code", width=v.width)
    df = neutralize(df, "bp", "neutral", width=v.width)
    rows = df.select("ts_code", "trade_date", F.col("ret_1").alias("ret"), "raw", "winsor_z", "industry_rank", "neutral")
    rows = rows.unpivot(["ts_code", "trade_date", "ret"], ["raw", "winsor_z", "industry_rank", "neutral"], "version", "f")
    return ev.ic_summary(ev.information_coefficients(rows, "f", ["version", "trade_date"], width=v.width), ["version"])


@query("tradability_filter", with_views(["daily_bars", "stock_basic"], r_sql([], "t", [*KEYS, "close"]), t="""SELECT d.ts_code, d.trade_date, d.close FROM daily_bars d JOIN stock_basic s ON d.ts_code = s.ts_code
    WHERE date_diff('day', strptime(list_date, '%Y%m%d')::DATE, trade_date) >= 60 AND coalesce(name NOT LIKE 'ST%' AND name NOT LIKE '*ST%', TRUE) AND vol > 1 AND NOT coalesce(close >= pre_close * 3 OR close <= pre_close * 0.3, FALSE)"""), exact=("close",))
def tradability_filter(v):
    bars = v.daily_bars()
    suspended = bars.where(F.col("vol") <= 1)
    limits = bars.withColumns({"up_limit": F.col("pre_close") * 3, "down_limit": F.col("pre_close") * 0.3})
    return ev.tradable(bars, v.stock_basic(), suspended, limits).select("ts_code", "trade_date", "close")


@query("training_labels", with_views(["daily_basic", "industry_static"], r_sql(["ret_5", "ret_rank", "ret_residual"], "l", [*KEYS, "top_10"]), r=RET,
    i="SELECT r.*, l1_name FROM r JOIN industry_static s ON r.ts_code = s.ts_code", **neutral_ctes("ret_5", "ret_residual", "i", None, "l1_name"),
    l=f"SELECT *, {avg_rank_sql('ret_5', 'trade_date', 'ret_rank')}, CASE WHEN ret_5 IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY trade_date ORDER BY ret_5 DESC NULLS LAST, ts_code) <= 10 AS INTEGER) END AS top_10 FROM n"))
def training_labels(v):
    """Forward-return labels: raw, cross-section rank, industry residual, top-10 hit."""
    df = with_returns(v).join(v.industry_static().select("ts_code", "l1_name"), "ts_code")
    df = neutralize(df, "ret_5", "ret_residual", sizes=[], width=v.width)
    df = xs.add_ranks(df, {"ret_rank": "ret_5"}, ["trade_date"], ["ts_code"], "ts_code", method="average", width=v.width)
    df = xs.add_top_k(df, "ret_5", "top_10", ["trade_date"], 10, ["ts_code"], "ts_code", width=v.width)
    return df.select("ts_code", "trade_date", "ret_5", "ret_rank", "ret_residual", "top_10")


# ------------------------------------------------------------------ universe
YEARS = (1996, 2001)
U_VIEWS = ["daily_basic", "industry_static", "stock_basic", "moneyflow", "daily_bars", "cal_ord"]
_U = {
    "ix": "SELECT b.ts_code, b.trade_date, b.circ_mv, l1_name, name, industry, list_date FROM daily_basic b JOIN industry_static i ON b.ts_code = i.ts_code JOIN stock_basic s ON b.ts_code = s.ts_code",
    "rb": f"SELECT trade_date AS rebal_date, ord AS r FROM cal_ord WHERE month(trade_date) IN (1, 7) AND year(trade_date) BETWEEN {YEARS[0]} AND {YEARS[1]} QUALIFY row_number() OVER (PARTITION BY year(trade_date), month(trade_date) ORDER BY trade_date) = 1",
    "el": """SELECT rebal_date, r, ts_code, coalesce(industry, l1_name) AS industry_label, circ_mv FROM ix JOIN rb ON trade_date = rebal_date
        WHERE coalesce(industry, l1_name) IS NOT NULL AND circ_mv IS NOT NULL AND list_date IS NOT NULL AND NOT coalesce(contains(name, 'ST'), FALSE)
        AND date_diff('day', strptime(list_date, '%Y%m%d')::DATE, rebal_date) >= 252""",
    "cv": """SELECT el.* FROM el WHERE (SELECT count(*) FROM moneyflow m JOIN cal_ord c ON m.trade_date = c.trade_date WHERE m.ts_code = el.ts_code AND c.ord BETWEEN el.r - 120 AND el.r - 1)
        >= {share} * least(el.r, 120) OR el.r = 0""",
    "lq": """SELECT cv.rebal_date, cv.ts_code, any_value(industry_label) AS industry_label, any_value(circ_mv) AS circ_mv, avg(amount) AS score FROM cv JOIN cal_ord c ON c.ord BETWEEN cv.r - 60 AND cv.r - 1
        JOIN daily_bars d ON d.trade_date = c.trade_date AND d.ts_code = cv.ts_code GROUP BY 1, 2 HAVING avg(amount) > 0""",
    "bk": f"SELECT *, CASE WHEN mv_rank BETWEEN 0 AND 0.35 THEN 'small' WHEN mv_rank <= 0.80 THEN 'mid' WHEN mv_rank <= 1 THEN 'big' END AS bucket FROM (SELECT *, {avg_rank_sql('circ_mv', 'rebal_date', 'mv_rank')} FROM lq)",
}


def u_steps(target: int, share: float = 0.95) -> dict[str, str]:
    return {
        **_U, "cv": _U["cv"].format(share=share),
        "q0": f"SELECT rebal_date, industry_label, count(*) AS n, {target} - 2 * count(*) OVER (PARTITION BY rebal_date) AS rest FROM bk GROUP BY 1, 2",
        "q1": f"""SELECT *, least(CAST(CASE WHEN rest < 0 THEN round_even(n / sum(n) OVER (PARTITION BY rebal_date) * {target}, 0)
            ELSE 2 + round_even(sqrt(n) / sum(sqrt(n)) OVER (PARTITION BY rebal_date) * rest, 0) END AS BIGINT), 12, n) AS s0 FROM q0""",
        "q2": f"SELECT *, {target} - sum(s0) OVER (PARTITION BY rebal_date) AS gap, row_number() OVER (PARTITION BY rebal_date ORDER BY n DESC, industry_label) AS so FROM q1",
        "q": "SELECT rebal_date, industry_label, n, CAST(s0 + CASE WHEN so <= abs(gap) THEN sign(gap) ELSE 0 END AS BIGINT) AS seats FROM q2",
        "b0": "SELECT bk.rebal_date, bk.industry_label, bucket, count(*) AS k, any_value(seats) AS seats FROM bk JOIN q ON bk.rebal_date = q.rebal_date AND bk.industry_label = q.industry_label WHERE seats > 0 GROUP BY 1, 2, 3",
        "b1": "SELECT *, CAST(round_even(k / sum(k) OVER (PARTITION BY rebal_date, industry_label) * seats, 0) AS BIGINT) AS bs FROM b0",
        "b": """SELECT rebal_date, industry_label, bucket, k, CAST(bs + CASE WHEN row_number() OVER (PARTITION BY rebal_date, industry_label ORDER BY k DESC, bucket) = 1
            THEN seats - sum(bs) OVER (PARTITION BY rebal_date, industry_label) ELSE 0 END AS BIGINT) AS b_seats FROM b1""",
        "c": """SELECT bk.*, b_seats, md5(ts_code || '|' || CAST(42 + year(bk.rebal_date) + month(bk.rebal_date) AS VARCHAR)) AS lot FROM bk JOIN b ON bk.rebal_date = b.rebal_date
            AND bk.industry_label = b.industry_label AND bk.bucket = b.bucket WHERE b_seats > 0
            QUALIFY row_number() OVER (PARTITION BY bk.rebal_date, bk.industry_label, bk.bucket ORDER BY score DESC, ts_code) <= 2 * b_seats""",
        "pool": "SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY rebal_date, industry_label, bucket ORDER BY lot, ts_code) <= b_seats",
    }


COVER = 0.6  # entities of the test tables trade in about four weeks of five


def _index(v):
    static = v.industry_static().select("ts_code", "l1_name")
    stocks = v.stock_basic().select("ts_code", "name", "industry", "list_date")
    return v.daily_basic().select("ts_code", "trade_date", "circ_mv").join(static, "ts_code").join(stocks, "ts_code")


def _candidates(v):
    v = v.staged("calendar", "daily_bars")
    return un.candidates(_index(v), v.daily_bars(), v.moneyflow(), v.calendar(), *YEARS, width=v.width, coverage_share=COVER)


@query("universe_static_pool", with_views(["daily_basic"], r_sql([], "t", [*KEYS, "circ_mv"]), t="SELECT ts_code, trade_date, circ_mv FROM daily_basic WHERE trade_date = (SELECT max(trade_date) FROM daily_basic) ORDER BY circ_mv DESC, ts_code LIMIT 20"), exact=("circ_mv",))
def universe_static_pool(v):
    return un.static_pool(v.daily_basic(), 20)


@query("universe_rebalance_dates", with_views(["cal_ord"], f"SELECT {ymd('rebal_date')} FROM rb", rb=_U["rb"]))
def universe_rebalance_dates(v):
    return un.rebalance_dates(v.calendar(), *YEARS)


@query("universe_eligible", with_views(["daily_basic", "industry_static", "stock_basic", "cal_ord"], r_sql([], "el", [ymd("rebal_date"), "ts_code", "industry_label", "circ_mv"]), ix=_U["ix"], rb=_U["rb"], el=_U["el"]), exact=("circ_mv",))
def universe_eligible(v):
    return un.eligible(_index(v), un.rebalance_dates(v.calendar(), *YEARS))


@query("universe_candidates", with_views(U_VIEWS, r_sql(["score", "mv_rank"], "bk", [ymd("rebal_date"), "ts_code", "industry_label", "bucket"], 7), **{k: s for k, s in u_steps(60, COVER).items() if k in _U}), digits=7)
def universe_candidates(v):
    return _candidates(v).drop("circ_mv")


@query("universe_industry_quotas", with_views(U_VIEWS, f"SELECT {ymd('rebal_date')}, industry_label, n, seats FROM q", **u_steps(60, COVER)))
def universe_industry_quotas(v):
    return un.industry_quotas(_candidates(v), 60)


@query("universe_industry_quotas_small_target", with_views(U_VIEWS, f"SELECT {ymd('rebal_date')}, industry_label, n, seats FROM q", **u_steps(20, COVER)))
def universe_industry_quotas_small_target(v):
    return un.industry_quotas(_candidates(v), 20)


@query("universe_bucket_quotas", with_views(U_VIEWS, f"SELECT {ymd('rebal_date')}, industry_label, bucket, k, b_seats FROM b", **u_steps(60, COVER)))
def universe_bucket_quotas(v):
    rows = _candidates(v)
    return un.bucket_quotas(rows, un.industry_quotas(rows, 60))


_POOL = with_views(U_VIEWS, f"SELECT {ymd('rebal_date')}, ts_code, industry_label, bucket FROM pool", **u_steps(60, COVER))


@query("universe_pool", _POOL)
def universe_pool(v):
    return un.build_pool(_candidates(v), 60).select("rebal_date", "ts_code", "industry_label", "bucket")


@query("universe_pool_split", _POOL)
def universe_pool_split(v):
    return un.build_pool(_candidates(v), 60, plan="split").select("rebal_date", "ts_code", "industry_label", "bucket")


@query("universe_pool_map", with_views(U_VIEWS, f"SELECT {ymd('rebal_date')}, string_agg(ts_code, ',' ORDER BY ts_code) AS codes FROM pool GROUP BY rebal_date", **u_steps(60, COVER)))
def universe_pool_map(v):
    return un.pool_map(un.build_pool(_candidates(v), 60)).select("rebal_date", F.concat_ws(",", "codes").alias("codes"))


@query("universe_pool_distribution", with_views(U_VIEWS, f"SELECT {ymd('rebal_date')}, bucket, count(*) AS members FROM pool GROUP BY 1, 2", **u_steps(60, COVER)))
def universe_pool_distribution(v):
    return un.pool_distribution(un.build_pool(_candidates(v), 60), "bucket")
