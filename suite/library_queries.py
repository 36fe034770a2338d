"""Joins, windows, ranks, clipping and regressions on the panel views."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from suite.common import ORACLES, query
from suite.factor_queries import BASE, KEYS, PIT, PIT_VIEWS, WC, avg_rank_sql, full_panel, neutral_ctes, pit_panel, rank_sql, z20_sql
from suite.view_sql import rounded as r_sql
from suite.view_sql import with_views
from tidepanel.functions import scalars as sc
from tidepanel.functions import timeseries as ts
from tidepanel.operators import cross_section as xs
from tidepanel.operators import pit
from tidepanel.operators.neutralize import neutralize
from tidepanel.operators.ordered import exact_quantiles, running_total
from tidepanel.operators.sliding import sliding_percentile
from tidepanel.operators.slices import last_value, over_rows, slice_keys
from tidepanel.plans import factors as fac
from tidepanel.session import cut_lineage

PAIR = ["roe", "roe_dt", "ebitda"]
W = ts.entity_window  # called per query: windows need a running session


def ymd(c: str) -> str:
    return f"strftime({c}, '%Y%m%d') AS {c}"


# ------------------------------------------------------------------ point-in-time joins
_ASOF = with_views(["daily_basic", "fina"], r_sql(["pb", *PAIR], "j", [*KEYS, ymd("ann_date")]),
                   j="SELECT b.ts_code, b.trade_date, b.pb, f.roe, f.roe_dt, f.ebitda, f.ann_date FROM daily_basic b ASOF LEFT JOIN fina f ON b.ts_code = f.ts_code AND b.trade_date >= f.ann_date")


def _asof(v, longest):
    reports = fac.effective_reports(v.fina_indicator(), PAIR, ["report_type"])
    basic = v.daily_basic().select("ts_code", "trade_date", "pb")
    return pit.asof_join(basic, reports, ["ts_code"], "trade_date", "ann_date", [*PAIR, "ann_date"], longest=longest, bounded=longest is None)


@query("asof_join", _ASOF)
def asof_join(v):
    return _asof(v, None)


@query("asof_join_time_sliced", _ASOF)
def asof_join_time_sliced(v):
    """Same join with every key of over 64 rows cut into slices, as keys longer than a partition always are."""
    return _asof(v, 64)


@query("asof_join_raw_rows", f"""SELECT l.l_suppkey, l.n_lines, strftime(l.t, '%Y%m%d') AS ship_date, strftime(o.t, '%Y%m%d') AS order_date, o.o_orderkey
    FROM (SELECT l_suppkey, l_shipdate AS t, count(*) AS n_lines FROM lineitem GROUP BY 1, 2) l ASOF LEFT JOIN
    (SELECT l_suppkey, o_orderdate AS t, max(o_orderkey) AS o_orderkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) o
    ON l.l_suppkey = o.l_suppkey AND l.t >= o.t""")
def asof_join_raw_rows(v):
    """Shipments matched to the supplier's last order placed by that day; several orders share a day."""
    lines = v.table("lineitem")
    left = lines.groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("ship_date")).agg(F.count(F.lit(1)).alias("n_lines"))
    placed = lines.select("l_suppkey", "l_orderkey").join(
        v.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").cast("date").alias("order_date")), "l_orderkey"
    ).withColumnRenamed("l_orderkey", "o_orderkey")
    return pit.asof_join(left, placed, ["l_suppkey"], "ship_date", "order_date", ["order_date", "o_orderkey"], right_order=["o_orderkey"])


@query("interval_asof_join", with_views(PIT_VIEWS, r_sql(["pb"], "pit", [*KEYS, "l1_name", "l2_name", "l3_name"]), pit=PIT))
def interval_asof_join(v):
    return pit_panel(v).select("ts_code", "trade_date", "pb", "l1_name", "l2_name", "l3_name")


@query("interval_range_join", with_views(PIT_VIEWS, r_sql(["pb"], "j", [*KEYS, "l1_name", "l2_name", "l3_name"]), j="""SELECT b.ts_code, b.trade_date, pb,
    coalesce(l1_name, 'Unknown') AS l1_name, coalesce(l2_name, 'Unknown') AS l2_name, coalesce(l3_name, 'Unknown') AS l3_name FROM daily_basic b
    LEFT JOIN industry_iv i ON b.ts_code = i.ts_code AND b.trade_date >= i.in_date AND b.trade_date < i.out_date
    QUALIFY row_number() OVER (PARTITION BY b.ts_code, b.trade_date ORDER BY i.in_date DESC) = 1"""))
def interval_range_join(v):
    return fac.point_in_time_panel(v.daily_basic(), v.industry_pit(), None, how="left").select("ts_code", "trade_date", "pb", "l1_name", "l2_name", "l3_name")


@query("trailing_calendar_join", with_views(["daily_bars", "cal_ord"], r_sql(["mean_amount"], "t", [ymd("rebal_date"), "ts_code", "n_dates"]), t="""SELECT r.trade_date AS rebal_date, d.ts_code, count(*) AS n_dates, avg(amount) AS mean_amount
    FROM (SELECT * FROM cal_ord WHERE month(trade_date) = 1) r JOIN cal_ord c ON c.ord BETWEEN r.ord - 60 AND r.ord - 1
    JOIN daily_bars d ON d.trade_date = c.trade_date GROUP BY 1, 2"""))
def trailing_calendar_join(v):
    cal = v.calendar()
    anchors = cal.where(F.month("trade_date") == 1).select(F.col("trade_date").alias("rebal_date"))
    spans = pit.trailing_dates(anchors, cal, 60)
    bars = v.daily_bars().select("ts_code", "trade_date", "amount")
    return bars.join(spans, "trade_date").groupBy("rebal_date", "ts_code").agg(F.count(F.lit(1)).alias("n_dates"), F.avg("amount").alias("mean_amount"))


@query("membership_daily_basic", with_views(["daily_basic", "industry_pit", "stock_basic"], r_sql([], "j", [*KEYS, "circ_mv", "l1_name", "name", "industry", "list_date"]), j="""SELECT b.ts_code, b.trade_date, l1_name, circ_mv, name, industry, list_date
    FROM daily_basic b JOIN industry_pit i ON b.ts_code = i.ts_code LEFT JOIN stock_basic s ON b.ts_code = s.ts_code"""), exact=("circ_mv",))
def membership_daily_basic(v):
    """Membership x daily rows (every membership of an entity), enriched with its attributes."""
    return index_daily(v)


def index_daily(v):
    members = v.industry_pit().select("ts_code", "l1_name")
    stocks = v.stock_basic().select("ts_code", "name", "industry", "list_date")
    return v.daily_basic().select("ts_code", "trade_date", "circ_mv").join(members, "ts_code").join(stocks, "ts_code", "left")


# ------------------------------------------------------------------ time-series windows
@query("ts_lag_change_zscore", with_views(["daily_bars"], r_sql(["roc5", "z20", "z20_lenient"], "t", [*KEYS, "lag1", "diff5"]), t=f"""SELECT ts_code, trade_date,
    lag(close, 1) {WC} AS lag1, close / nullif(lag(close, 5) {WC}, 0) - 1 AS roc5, close - lag(close, 5) {WC} AS diff5,
    {z20_sql('close', 'z20')}, {z20_sql('close', 'z20_lenient', 20, '>= 10')} FROM daily_bars"""), exact=("lag1", "diff5"))
def ts_lag_change_zscore(v):
    bars = v.daily_bars()
    return bars.select("ts_code", "trade_date", ts.lag("close", 1, W()).alias("lag1"), ts.roc("close", 5, W()).alias("roc5"), ts.diff("close", 5, W()).alias("diff5"),
                       ts.zscore("close", 20, W()).alias("z20"), ts.zscore("close", 20, W(), min_periods=10).alias("z20_lenient"))


@query("ts_fill_with_limit", with_views(["moneyflow"], r_sql(["ff2", "bf1", "ff_all"], "t", KEYS), t="""SELECT ts_code, trade_date,
    last_value(buy_elg_amount IGNORE NULLS) OVER (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS ff2,
    first_value(buy_elg_amount IGNORE NULLS) OVER (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN CURRENT ROW AND 1 FOLLOWING) AS bf1,
    last_value(buy_elg_amount IGNORE NULLS) OVER (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ff_all FROM moneyflow"""))
def ts_fill_with_limit(v):
    x = "buy_elg_amount"
    return v.moneyflow().select("ts_code", "trade_date", ts.forward_fill(x, W(), 2).alias("ff2"), ts.backward_fill(x, W(), 1).alias("bf1"), ts.forward_fill(x, W()).alias("ff_all"))


# The same rows with every key of over 100 rows cut into slices, as keys longer than a partition always are.

@query("ts_lag_change_zscore_sliced", ORACLES["ts_lag_change_zscore"], exact=("lag1", "diff5"))
def ts_lag_change_zscore_sliced(v):
    bars = v.daily_bars().select("ts_code", "trade_date", "close")
    columns = lambda w: {
        "lag1": ts.lag("close", 1, w), "roc5": ts.roc("close", 5, w), "diff5": ts.diff("close", 5, w), "z20": ts.zscore("close", 20, w), "z20_lenient": ts.zscore("close", 20, w, min_periods=10)}
    return over_rows(bars, ["ts_code"], ["trade_date"], columns, before=19, longest=100).drop("close")


@query("ts_fill_with_limit_sliced", ORACLES["ts_fill_with_limit"])
def ts_fill_with_limit_sliced(v):
    x, by, order = "buy_elg_amount", ["ts_code"], ["trade_date"]
    near = over_rows(v.moneyflow().select("ts_code", "trade_date", x), by, order, lambda w: {"ff2": ts.forward_fill(x, w, 2), "bf1": ts.backward_fill(x, w, 1)}, before=2, after=1, longest=100)
    return last_value(slice_keys(cut_lineage(near), by, order, 100), by, order, x, "ff_all").drop(x)


_LINE = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_partkey", "l_suppkey"]
_LINES = f"(PARTITION BY l_returnflag ORDER BY {', '.join(_LINE)})"


@query("ts_raw_line_windows", r_sql(["change5", "mean20", "next_ret"], f"""(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, lag(l_extendedprice, 3) OVER w AS lag3,
    l_quantity - lag(l_quantity, 5) OVER w AS change5, CASE WHEN count(*) OVER w20 = 20 THEN avg(l_extendedprice) OVER w20 END AS mean20, lead(l_extendedprice) OVER w / l_extendedprice - 1 AS next_ret FROM lineitem
    WINDOW w AS {_LINES}, w20 AS {_LINES[:-1]} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))""", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "lag3"]), exact=("lag3",))
def ts_raw_line_windows(v):
    """Windows over raw rows: three keys hold the whole table, so each is cut."""
    lines = v.table("lineitem").select(*_LINE, "l_returnflag")
    columns = lambda w: {
        "lag3": ts.lag("l_extendedprice", 3, w), "change5": ts.diff("l_quantity", 5, w), "mean20": ts.rolling_mean("l_extendedprice", 20, w), "next_ret": ts.forward_return("l_extendedprice", 1, w)}
    out = over_rows(lines, ["l_returnflag"], _LINE, columns, before=19, after=1)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "lag3", "change5", "mean20", "next_ret")


_FR = "OVER (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN {k} PRECEDING AND CURRENT ROW)"


@query("ts_rolling_percentile", with_views(["daily_bars"], r_sql(["pct60", "ma5", "ma20", "liq_shock"], "t", KEYS, 4), t=f"""SELECT ts_code, trade_date, pct60, ma5, ma20, amount / nullif(ma20, 0) - 1 AS liq_shock FROM (
    SELECT ts_code, trade_date, amount, len(list_filter(list(amount) {_FR.format(k=59)}, lambda x: x <= amount)) / count(amount) {_FR.format(k=59)} AS pct60,
    CASE WHEN count(amount) {_FR.format(k=4)} = 5 THEN avg(amount) {_FR.format(k=4)} END AS ma5,
    CASE WHEN count(amount) {_FR.format(k=19)} = 20 THEN avg(amount) {_FR.format(k=19)} END AS ma20 FROM daily_bars)"""), digits=4)
def ts_rolling_percentile(v):
    bars = sliding_percentile(v.daily_bars().select("ts_code", "trade_date", "amount"), ["ts_code"], ["trade_date"], "amount", 60, "pct60")
    return bars.select(
        "ts_code", "trade_date", "pct60", ts.rolling_mean("amount", 5, W()).alias("ma5"),
        ts.rolling_mean("amount", 20, W()).alias("ma20"), (sc.ratio("amount", ts.rolling_mean("amount", 20, W())) - 1).alias("liq_shock"))


@query("ts_own_history_percentile", with_views(["daily_bars"], r_sql(["pct252"], "t", KEYS), t=f"""SELECT ts_code, trade_date,
    CASE WHEN count(pre_close) {_FR.format(k=251)} >= 60 THEN len(list_filter(list(pre_close) {_FR.format(k=251)}, lambda x: x <= pre_close)) / count(pre_close) {_FR.format(k=251)} END AS pct252 FROM daily_bars"""))
def ts_own_history_percentile(v):
    """Rank in the own last 252 rows, from 60 present values on; the first row of an entity has none."""
    return sliding_percentile(v.daily_bars().select("ts_code", "trade_date", "pre_close"), ["ts_code"], ["trade_date"], "pre_close", 252, "pct252", min_periods=60).drop("pre_close")


@query("ts_expression_templates", with_views(["daily_bars"], r_sql(["m10", "s10", "r10", "rel"], "t", [*KEYS, "d10", "ref3", "body"], 4), t=f"""SELECT ts_code, trade_date,
    CASE WHEN n = 10 THEN avg(close) {_FR.format(k=9)} END AS m10, CASE WHEN n = 10 THEN stddev_samp(close) {_FR.format(k=9)} END AS s10,
    CASE WHEN n = 10 THEN len(list_filter(list(close) {_FR.format(k=9)}, lambda x: x <= close)) / 10 END AS r10,
    close - lag(close, 10) {WC} AS d10, lag(close, 3) {WC} AS ref3, close - open AS body, close / nullif(open, 0) AS rel
    FROM (SELECT *, count(close) {_FR.format(k=9)} AS n FROM daily_bars)"""), digits=4, exact=("d10", "ref3", "body"))
def ts_expression_templates(v):
    return v.daily_bars().select(
        "ts_code", "trade_date", ts.ts_mean("close", 10, W()).alias("m10"), ts.ts_std("close", 10, W()).alias("s10"), ts.ts_rank("close", 10, W()).alias("r10"),
        ts.ts_delta("close", 10, W()).alias("d10"), ts.ref("close", 3, W()).alias("ref3"), ts.sub("close", "open").alias("body"), ts.div("close", "open").alias("rel"))


# ------------------------------------------------------------------ ranks
_ORD = with_views(["daily_basic"], r_sql(["pe_rank", "pb_rank", "pb_rank_desc"], "t", KEYS), t=f"""SELECT ts_code, trade_date,
    {rank_sql('pe_ttm', '1', 'pe_rank')}, {rank_sql('pb', '1', 'pb_rank')}, {rank_sql('pb', '1', 'pb_rank_desc', True)} FROM daily_basic""")


def _ordinal(v, plan):
    df = v.daily_basic().select("ts_code", "trade_date", "pe_ttm", "pb")
    ranks = {"pe_rank": "pe_ttm", "pb_rank": "pb", "pb_rank_desc": "pb"}
    return xs.add_ranks(df, ranks, ["trade_date"], ["ts_code"], "ts_code", descending=["pb_rank_desc"], plan=plan).select("ts_code", "trade_date", *ranks)


@query("cs_rank_ordinal", _ORD)
def cs_rank_ordinal(v):
    return _ordinal(v, "window")


@query("cs_rank_ordinal_split", _ORD)
def cs_rank_ordinal_split(v):
    return _ordinal(v, "split")


_AVG = with_views(["daily_basic"], r_sql(["dv_rank", "pe_rank"], "t", KEYS), t=f"SELECT ts_code, trade_date, {avg_rank_sql('dv_ttm', 'trade_date', 'dv_rank')}, {avg_rank_sql('pe_ttm', 'trade_date', 'pe_rank')} FROM daily_basic")


def _average(v, plan):
    df = v.daily_basic().select("ts_code", "trade_date", "dv_ttm", "pe_ttm")
    return xs.add_ranks(df, {"dv_rank": "dv_ttm", "pe_rank": "pe_ttm"}, ["trade_date"], ["ts_code"], "ts_code", method="average", plan=plan).drop("dv_ttm", "pe_ttm")


@query("cs_rank_average", _AVG)
def cs_rank_average(v):
    return _average(v, "window")


@query("cs_rank_average_split", _AVG)
def cs_rank_average_split(v):
    return _average(v, "split")


_IND = with_views(PIT_VIEWS, r_sql(["r_min5", "r_any", "n"], "t", KEYS), pit=PIT, t=f"""SELECT ts_code, trade_date, CASE WHEN n >= 5 THEN r_any END AS r_min5, r_any, n FROM (
    SELECT *, {rank_sql('pb', 'l2_name', 'r_any')}, CAST(count(pb) OVER (PARTITION BY trade_date, l2_name) AS DOUBLE) AS n FROM pit)""")


def _industry(v, plan):
    df = pit_panel(v).select("ts_code", "trade_date", "l2_name", "pb")
    by = ["trade_date", "l2_name"]
    df = xs.add_ranks(df, {"r_any": "pb"}, by, ["ts_code"], "ts_code", plan=plan)
    df = xs.add_ranks(df, {"r_min5": "pb"}, by, ["ts_code"], "ts_code", min_n=5, plan=plan)
    return df.select("ts_code", "trade_date", "r_min5", "r_any", F.count("pb").over(Window.partitionBy(*by)).cast("double").alias("n"))


@query("industry_rank_min_n", _IND)
def industry_rank_min_n(v):
    return _industry(v, "window")


@query("industry_rank_split", _IND)
def industry_rank_split(v):
    return _industry(v, "split")


@query("industry_rank_fallback", with_views(PIT_VIEWS, r_sql(["r"], "t", KEYS), pit=PIT, t=f"""SELECT ts_code, trade_date, CASE WHEN n3 >= 8 AND r3 IS NOT NULL THEN r3 WHEN n2 >= 8 AND r2 IS NOT NULL THEN r2 ELSE r1 END AS r FROM (
    SELECT *, {rank_sql('pb', 'l3_name', 'r3')}, {rank_sql('pb', 'l2_name', 'r2')}, {rank_sql('pb', 'l1_name', 'r1')},
    count(pb) OVER (PARTITION BY trade_date, l3_name) AS n3, count(pb) OVER (PARTITION BY trade_date, l2_name) AS n2 FROM pit)"""))
def industry_rank_fallback(v):
    df = xs.add_rank_with_fallback(pit_panel(v), "pb", "r", "trade_date", ["l3_name", "l2_name", "l1_name"], ["ts_code"], "ts_code", width=v.width)
    return df.select("ts_code", "trade_date", "r")


# ------------------------------------------------------------------ buckets, clipping, standardization
def bucket_sql(x: str, part: str, q: int, out: str) -> str:
    ps = ", ".join(repr(i / q) for i in range(q + 1))
    return (f"CASE WHEN {x} IS NOT NULL THEN greatest(1, len(list_filter(list_distinct(quantile_cont({x}, [{ps}]) OVER (PARTITION BY {part})), lambda e: e < {x}))) END AS {out}")


_BUCKET = with_views(["daily_basic"], "SELECT ts_code, strftime(trade_date, '%Y%m%d') AS trade_date, CAST(b_pb AS INTEGER) AS b_pb, CAST(b_dv AS INTEGER) AS b_dv FROM t",
                     t=f"SELECT ts_code, trade_date, {bucket_sql('pb', 'trade_date', 5, 'b_pb')}, {bucket_sql('dv_ttm', 'trade_date', 5, 'b_dv')} FROM daily_basic")


def _buckets(v, plan):
    df = v.daily_basic().select("ts_code", "trade_date", "pb", "dv_ttm")
    df = xs.add_bucket(df, "pb", ["trade_date"], 5, "b_pb", plan=plan)
    return xs.add_bucket(df, "dv_ttm", ["trade_date"], 5, "b_dv", plan=plan).drop("pb", "dv_ttm")


@query("quantile_bucket", _BUCKET)
def quantile_bucket(v):
    return _buckets(v, "window")


@query("quantile_bucket_split", _BUCKET)
def quantile_bucket_split(v):
    return _buckets(v, "split")


def decile_sql(x: str, by: str, table: str) -> str:
    """Deciles from sorted lists, with the interpolation written out."""
    return f"""SELECT ts_code, strftime(t.trade_date, '%Y%m%d') AS trade_date, CASE WHEN {x} IS NOT NULL THEN CAST(greatest(1, len(list_filter(list_distinct(edges), lambda e: e < {x}))) AS INTEGER) END AS decile
    FROM {table} t LEFT JOIN (SELECT {by}, list_transform([{', '.join(repr(i / 10) for i in range(11))}], lambda p: CASE WHEN xs[CAST(floor(p * (len(xs) - 1)) AS BIGINT) + 1] = xs[CAST(ceil(p * (len(xs) - 1)) AS BIGINT) + 1]
        THEN xs[CAST(floor(p * (len(xs) - 1)) AS BIGINT) + 1] ELSE (ceil(p * (len(xs) - 1)) - p * (len(xs) - 1)) * xs[CAST(floor(p * (len(xs) - 1)) AS BIGINT) + 1] + (p * (len(xs) - 1) - floor(p * (len(xs) - 1))) * xs[CAST(ceil(p * (len(xs) - 1)) AS BIGINT) + 1] END) AS edges
    FROM (SELECT {by}, list({x} ORDER BY {x}) FILTER (WHERE {x} IS NOT NULL) AS xs FROM {table} GROUP BY 1)) q ON t.{by} = q.{by}"""


_DECILE = with_views(["daily_basic"], decile_sql("pb", "trade_date", "daily_basic"))


def _deciles(v, plan):
    return xs.add_bucket(v.daily_basic().select("ts_code", "trade_date", "pb"), "pb", ["trade_date"], 10, "decile", plan=plan).drop("pb")


@query("quantile_bucket_decile", _DECILE)
def quantile_bucket_decile(v):
    return _deciles(v, "window")


@query("quantile_bucket_decile_split", _DECILE)
def quantile_bucket_decile_split(v):
    return _deciles(v, "split")


@query("bucket_in_industry_vs_market", with_views(PIT_VIEWS, r_sql(["mean_pe"], "t", ["scope", "bucket", "n"], 4), pit=PIT, b=f"""SELECT pe_ttm, {bucket_sql('pb', 'trade_date, l1_name', 3, 'bi')}, {bucket_sql('pb', 'trade_date', 3, 'bm')} FROM pit""",
    t="SELECT 'industry' AS scope, CAST(bi AS INTEGER) AS bucket, count(*) AS n, avg(pe_ttm) AS mean_pe FROM b GROUP BY 2 UNION ALL SELECT 'market', CAST(bm AS INTEGER), count(*), avg(pe_ttm) FROM b GROUP BY 2"), digits=4)
def bucket_in_industry_vs_market(v):
    df = pit_panel(v).select("ts_code", "trade_date", "l1_name", "pb", "pe_ttm")
    df = xs.add_bucket(df, "pb", ["trade_date", "l1_name"], 3, "industry", width=v.width)
    df = xs.add_bucket(df, "pb", ["trade_date"], 3, "market", width=v.width)
    return df.unpivot(["pe_ttm"], ["industry", "market"], "scope", "bucket").groupBy("scope", "bucket").agg(F.count(F.lit(1)).alias("n"), F.avg("pe_ttm").alias("mean_pe"))


_WINSOR = with_views(["daily_basic"], r_sql(["pb_w", "pb_z"], "t", KEYS), w="""SELECT b.ts_code, b.trade_date, least(greatest(pb, lo), hi) AS pb_w FROM daily_basic b
    JOIN (SELECT trade_date, quantile_cont(pb, 0.02) AS lo, quantile_cont(pb, 0.98) AS hi FROM daily_basic GROUP BY 1) q ON b.trade_date = q.trade_date""",
    t="SELECT *, CASE WHEN max(pb_w) OVER d > min(pb_w) OVER d THEN (pb_w - avg(pb_w) OVER d) / stddev_samp(pb_w) OVER d ELSE pb_w - avg(pb_w) OVER d END AS pb_z FROM w WINDOW d AS (PARTITION BY trade_date)")


def _winsor(v, plan):
    df = v.daily_basic().select("ts_code", "trade_date", F.col("pb").alias("pb_w"))
    df = xs.winsorize(df, ["pb_w"], ["trade_date"], plan=plan)
    return xs.standardize(df.withColumn("pb_z", F.col("pb_w")), ["pb_z"], ["trade_date"])


@query("winsorize_standardize", _WINSOR)
def winsorize_standardize(v):
    return _winsor(v, "window")


@query("winsorize_standardize_split", _WINSOR)
def winsorize_standardize_split(v):
    return _winsor(v, "split")


@query("whole_table_clipping", """WITH s AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS sd, quantile_cont(l_extendedprice, 0.01) AS q1,
    quantile_cont(l_extendedprice, 0.99) AS q9, median(l_extendedprice) AS med FROM lineitem),
    a AS (SELECT median(abs(l_extendedprice - med)) AS mad FROM lineitem, s)
    SELECT l_orderkey, l_linenumber, round(least(greatest(l_extendedprice, m - 1.5 * sd), m + 1.5 * sd), 4) AS by_sigma,
    round(least(greatest(l_extendedprice, q1), q9), 4) AS by_quantile, round(least(greatest(l_extendedprice, med - 1.2 * mad), med + 1.2 * mad), 4) AS by_mad FROM lineitem, s, a""", digits=4)
def whole_table_clipping(v):
    df = v.table("lineitem").select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("x"))
    df = xs.clip_sigma(df, {"by_sigma": "x"}, 1.5)
    df = xs.clip_quantile(df, {"by_quantile": "x"})
    return xs.clip_mad(df, {"by_mad": "x"}, 1.2).drop("x")


@query("exact_quantiles", """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS q25, round(median(l_extendedprice), 4) AS q50, round(quantile_cont(l_extendedprice, 0.99), 4) AS q99 FROM lineitem GROUP BY 1""", digits=4)
def quantiles_linear(v):
    return exact_quantiles(v.table("lineitem"), ["l_returnflag"], "l_extendedprice", {"q25": 0.25, "q50": 0.5, "q99": 0.99})


@query("exact_quantiles_nearest", """WITH r AS (SELECT l_returnflag, l_extendedprice AS x, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS i, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
    SELECT l_returnflag, max(CASE WHEN i = floor(0.02 * (n - 1) + 0.5) THEN x END) AS q02, max(CASE WHEN i = floor(0.98 * (n - 1) + 0.5) THEN x END) AS q98 FROM r GROUP BY 1""")
def quantiles_nearest(v):
    return exact_quantiles(v.table("lineitem"), ["l_returnflag"], "l_extendedprice", {"q02": 0.02, "q98": 0.98}, interpolation="nearest")


@query("running_total_split", """SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice, o_orderkey) - 1 AS BIGINT) AS pos FROM orders""")
def running_total_split(v):
    """Position of every order inside its status; three groups share the whole table."""
    df = v.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return running_total(df, ["o_orderstatus"], ["o_totalprice", "o_orderkey"]).select("o_orderkey", "pos")


# ------------------------------------------------------------------ neutralization
_NEU_BASE = BASE.format(src="pit")


def _neutral_sql(size, industry):
    return with_views(PIT_VIEWS, r_sql(["res"], "n", KEYS), pit=PIT, base=_NEU_BASE, **neutral_ctes("ep_ttm", "res", "base", size, industry))


_NEU_SIZE = _neutral_sql("ln(circ_mv)", "l1_name")


@query("neutralize_industry_size", _NEU_SIZE)
def neutralize_industry_size(v):
    return neutralize(fac.base_factors(pit_panel(v)), "ep_ttm", "res", width=v.width).select("ts_code", "trade_date", "res")


@query("neutralize_industry_size_split", _NEU_SIZE)
def neutralize_industry_size_split(v):
    df = fac.base_factors(pit_panel(v)).select("ts_code", "trade_date", "l1_name", "ep_ttm", "circ_mv")
    return neutralize(df, "ep_ttm", "res", plan="split").select("ts_code", "trade_date", "res")


@query("neutralize_null_industry", with_views(["daily_basic", "stock_basic"], r_sql(["res"], "n", KEYS), base=BASE.format(src="(SELECT b.*, industry FROM daily_basic b JOIN stock_basic s ON b.ts_code = s.ts_code)"),
                                             **neutral_ctes("ep_ttm", "res", "base", "ln(circ_mv)", "industry")))
def neutralize_null_industry(v):
    """Rows without an industry take no part and get no residual."""
    df = fac.base_factors(v.daily_basic().join(v.stock_basic().select("ts_code", "industry"), "ts_code"))
    return neutralize(df, "ep_ttm", "res", industry="industry", width=v.width).select("ts_code", "trade_date", "res")


@query("neutralize_industry_only", _neutral_sql(None, "l1_name"))
def neutralize_industry_only(v):
    return neutralize(fac.base_factors(pit_panel(v)), "ep_ttm", "res", sizes=[], width=v.width).select("ts_code", "trade_date", "res")


_TWO = {
    "n0": "SELECT *, ep_ttm IS NOT NULL AND turnover_rate_f > 0 AS _ok, CASE WHEN turnover_rate_f > 0 THEN ep_ttm END AS y, CASE WHEN ep_ttm IS NOT NULL AND turnover_rate_f > 0 THEN ln(circ_mv) END AS s, CASE WHEN ep_ttm IS NOT NULL AND turnover_rate_f > 0 THEN ln(turnover_rate_f) END AS t FROM base",
    "nq": ", ".join(["SELECT trade_date, count(y) AS nv", *[f"quantile_cont({c}, 0.02) AS {c}l, quantile_cont({c}, 0.98) AS {c}h" for c in "yst"]]) + " FROM n0 GROUP BY 1",
    "n1": "SELECT a.ts_code, a.trade_date, a.l1_name, nv, _ok, " + ", ".join(f"CASE WHEN {c} IS NOT NULL THEN least(greatest({c}, {c}l), {c}h) END AS {c}" for c in "yst") + " FROM n0 a JOIN nq q ON a.trade_date = q.trade_date",
    "n2": "SELECT *, " + ", ".join(f"{c} - avg({c}) OVER (PARTITION BY trade_date, l1_name) AS d{c}" for c in "yst") + " FROM n1",
    "nb": "SELECT trade_date, sum(ds*ds) AS ss, sum(dt*dt) AS tt, sum(ds*dt) AS st, sum(ds*dy) AS sy, sum(dt*dy) AS ty FROM n2 GROUP BY 1",
    "n": "SELECT a.*, CASE WHEN _ok AND nv >= 30 THEN dy - coalesce((sy*tt - ty*st) / nullif(ss*tt - st*st, 0), 0) * ds - coalesce((ty*ss - sy*st) / nullif(ss*tt - st*st, 0), 0) * dt END AS res FROM n2 a JOIN nb b ON a.trade_date = b.trade_date",
}


@query("neutralize_size_liquidity", with_views(PIT_VIEWS, r_sql(["res"], "n", KEYS), pit=PIT, base=_NEU_BASE, **_TWO))
def neutralize_size_liquidity(v):
    return neutralize(fac.base_factors(pit_panel(v)), "ep_ttm", "res", sizes=["circ_mv", "turnover_rate_f"], width=v.width).select("ts_code", "trade_date", "res")


# logarithms and share ratios would tie or not by the last bit, engine by engine
_BASE_FACTORS = ["ep_ttm", "bp", "sp_ttm", "div_ttm_val", "turnover_rate_f", "volume_ratio", "pb"]
_TCOLS = [f"{c}_{x}" for c in _BASE_FACTORS for x in ("lag", "roc", "diff", "z", "pct", "rank", "ind_rank")]
_TEMPLATE = ", ".join(f"""lag({c}, 1) {WC} AS {c}_lag, {c} / nullif(lag({c}, 20) {WC}, 0) - 1 AS {c}_roc, {c} - lag({c}, 20) {WC} AS {c}_diff, {z20_sql(c, f'{c}_z')},
    CASE WHEN {c} IS NOT NULL THEN len(list_filter(list({c}) {_FR.format(k=19)}, lambda x: x <= {c})) / count({c}) {_FR.format(k=19)} END AS {c}_pct,
    {rank_sql(c, '1', f'{c}_rank')}, {rank_sql(c, 'l2_name', f'{c}_ind_rank')}, {bucket_sql(c, 'trade_date', 5, f'{c}_bucket')}""" for c in _BASE_FACTORS)


@query("operator_template", with_views(PIT_VIEWS, r_sql([*_TCOLS, "inter"], "t", [*KEYS, *[f"CAST({c}_bucket AS INTEGER) AS {c}_bucket" for c in _BASE_FACTORS]]), pit=PIT, base=_NEU_BASE,
    t=f"SELECT ts_code, trade_date, {_TEMPLATE}, bp * turn_f AS inter FROM base"))
def operator_template(v):
    """The template on seven columns."""
    df = fac.templated(fac.base_factors(pit_panel(v)), _BASE_FACTORS, width=v.width)
    return df.withColumn("inter", fac.interaction("bp", "turn_f")).select("ts_code", "trade_date", *_TCOLS, "inter", *[f"{c}_bucket" for c in _BASE_FACTORS])


@query("csnorm_model_columns", with_views(PIT_VIEWS, r_sql(["bp_z", "bp_csnorm"], "n", KEYS), pit=PIT, base=_NEU_BASE,
    w="SELECT b.*, least(greatest(bp, lo), hi) AS bw FROM base b JOIN (SELECT trade_date, quantile_cont(bp, 0.02) AS lo, quantile_cont(bp, 0.98) AS hi FROM base GROUP BY 1) q ON b.trade_date = q.trade_date",
    z="SELECT *, CASE WHEN max(bw) OVER d > min(bw) OVER d THEN (bw - avg(bw) OVER d) / stddev_samp(bw) OVER d ELSE bw - avg(bw) OVER d END AS bp_z FROM w WINDOW d AS (PARTITION BY trade_date)",
    **neutral_ctes("bp_z", "bp_csnorm", "z", None, "l1_name")))
def csnorm_model_columns(v):
    """Cross-section normalized variant: winsorize, standardize, industry residual."""
    df = fac.base_factors(pit_panel(v)).withColumn("bp_z", F.col("bp"))
    df = xs.standardize(xs.winsorize(df, ["bp_z"], ["trade_date"], plan="window"), ["bp_z"], ["trade_date"])
    return neutralize(df, "bp_z", "bp_csnorm", sizes=[], plan="window").select("ts_code", "trade_date", "bp_z", "bp_csnorm")


_ROBUST = with_views(["daily_basic"], r_sql(["pb_r"], "t", KEYS), w="""SELECT b.ts_code, b.trade_date, least(greatest(pb, lo), hi) AS x FROM daily_basic b
    JOIN (SELECT trade_date, quantile_cont(pb, 0.02) AS lo, quantile_cont(pb, 0.98) AS hi FROM daily_basic GROUP BY 1) q ON b.trade_date = q.trade_date""",
    m="SELECT *, quantile_cont(x, 0.5) OVER (PARTITION BY trade_date) AS med FROM w", d="SELECT *, quantile_cont(abs(x - med), 0.5) OVER (PARTITION BY trade_date) AS mad FROM m",
    t="SELECT ts_code, trade_date, CASE WHEN mad > 0 THEN (x - med) / (mad * 1.4826) ELSE x - med END AS pb_r FROM d")


def _robust(v, plan):
    df = v.daily_basic().select("ts_code", "trade_date", F.col("pb").alias("pb_r"))
    return xs.robust_standardize(xs.winsorize(df, ["pb_r"], ["trade_date"], plan=plan), ["pb_r"], ["trade_date"], plan=plan)


@query("csnorm_robust_zscore", _ROBUST)
def csnorm_robust_zscore(v):
    return _robust(v, "window")


@query("csnorm_robust_zscore_split", _ROBUST)
def csnorm_robust_zscore_split(v):
    return _robust(v, "split")


@query("top_k_per_date_split", with_views(["daily_basic"], "SELECT ts_code, strftime(trade_date, '%Y%m%d') AS trade_date, hit FROM t",
                                          t="SELECT ts_code, trade_date, CASE WHEN pe_ttm IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY trade_date ORDER BY pe_ttm DESC NULLS LAST, ts_code) <= 10 AS INTEGER) END AS hit FROM daily_basic"))
def top_k_per_date_split(v):
    df = v.daily_basic().select("ts_code", "trade_date", "pe_ttm")
    return xs.add_top_k(df, "pe_ttm", "hit", ["trade_date"], 10, ["ts_code"], "ts_code", plan="split").drop("pe_ttm")


@query("alternative_composites_split", ORACLES["alternative_composites"])
def alternative_composites_split(v):
    df = fac.reported_factors(fac.daily_factors(full_panel(v), plan="window"), plan="window")
    terms = [n for w in fac.ALTERNATIVE_COMPOSITES.values() for n in w]
    df = df.select("ts_code", "trade_date", "l2_name", *dict.fromkeys(["turn_f_z20", "vol_ratio_z20", *[n for n in terms if n in df.columns]]))
    return fac.alternative_composites(df, plan="split").select("ts_code", "trade_date", *fac.ALTERNATIVE_COMPOSITES)
