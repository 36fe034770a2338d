"""The panel views as DuckDB common table expressions."""

from __future__ import annotations

from tidepanel.sources.star_views import COST_POINTS, FINANCIAL_COLUMNS, LEGS, financial_metric

ORD = "l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_partkey"
LEG = "CASE WHEN l_quantity <= 12 THEN 'sm' WHEN l_quantity <= 25 THEN 'md' WHEN l_quantity <= 38 THEN 'lg' ELSE 'elg' END"


def _code(col: str) -> str:
    return f"lpad(CAST({col} AS VARCHAR), 10, '0')"


def _ymd(col: str) -> str:
    return f"strftime({col}, '%Y%m%d')"


_LEG_SUMS = ", ".join(
    f"round(sum(l_extendedprice) FILTER (WHERE {LEG} = '{leg}' AND l_returnflag {op} 'R'), 2) / 10 AS {side}_{leg}_amount"
    for leg in LEGS for side, op in (("buy", "<>"), ("sell", "="))
)
_COSTS = ", ".join(f"quantile_cont(price, {p / 100}) AS cost_{p}pct" for p in COST_POINTS)
_METRICS = ", ".join(f"{financial_metric(i, n)} AS {n}" for i, n in enumerate(FINANCIAL_COLUMNS))

# name -> (needed views, body)
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "li": ((), f"""SELECT *, {_code('l_suppkey')} AS ts_code, CAST(date_trunc('week', l_shipdate) AS DATE) AS trade_date,
        l_extendedprice / l_quantity AS price FROM lineitem"""),
    "daily_bars": (("li",), f"""SELECT *, lag(close) OVER (PARTITION BY ts_code ORDER BY trade_date) AS pre_close FROM (
        SELECT ts_code, trade_date, first(price ORDER BY {ORD}) AS open, last(price ORDER BY {ORD}) AS close,
        max(price) AS high, min(price) AS low, sum(l_quantity) AS vol, round(sum(l_extendedprice), 2) AS amount
        FROM li GROUP BY ts_code, trade_date)"""),
    "daily_basic": (("li",), f"""SELECT ts_code, trade_date, close, turnover_rate_f, volume_ratio, pe_ttm, pb, ps_ttm, dv_ttm, total_share,
        float_share, free_share, close * total_share AS total_mv, close * float_share AS circ_mv FROM (
        SELECT w.ts_code, trade_date, close, vol / 10 AS turnover_rate_f,
        vol / nullif(avg(vol) OVER (PARTITION BY w.ts_code ORDER BY trade_date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING), 0) AS volume_ratio,
        close / nullif(round(100 * disc), 0) AS pe_ttm, close / (retail / n) AS pb, amount / nullif(round(1000 * tax), 0) AS ps_ttm,
        round(100 * disc) / n AS dv_ttm, total_share, total_share * 9 / 10 AS float_share,
        (n + 2 * disc) * total_share / (2 * n) AS free_share
        FROM (SELECT ts_code, trade_date, last(price ORDER BY {ORD}) AS close, sum(l_quantity) AS vol,
            round(sum(l_extendedprice), 2) AS amount, round(sum(l_discount), 2) AS disc, round(sum(l_tax), 2) AS tax,
            count(*) AS n, round(sum(p_retailprice), 2) AS retail
            FROM li JOIN part ON l_partkey = p_partkey GROUP BY ts_code, trade_date) w
        JOIN (SELECT {_code('s_suppkey')} AS ts_code, 1000 + abs(s_acctbal) AS total_share FROM supplier) s ON w.ts_code = s.ts_code)"""),
    "moneyflow": (("li",), f"""SELECT ts_code, trade_date, {_LEG_SUMS},
        round(sum(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END), 2) / 10 AS net_mf_amount
        FROM li GROUP BY ts_code, trade_date"""),
    "cost_month": (("li",), f"""SELECT ts_code, CAST(date_trunc('month', l_shipdate) AS DATE) AS month, {_COSTS},
        round(sum(l_extendedprice), 2) / sum(l_quantity) AS weight_avg FROM li GROUP BY 1, 2"""),
    "cost_bars": (("daily_bars",), """SELECT ts_code, trade_date, close, CAST(date_trunc('month', trade_date) AS DATE) AS month,
        min(low) OVER w AS his_low, max(high) OVER w AS his_high FROM daily_bars
        WINDOW w AS (PARTITION BY ts_code ORDER BY trade_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""),
    "cost_win": (("cost_bars", "li"), """SELECT b.ts_code, b.trade_date,
        100 * count(*) FILTER (WHERE price <= close) / count(*) AS winner_rate
        FROM cost_bars b JOIN li l ON b.ts_code = l.ts_code AND b.month = CAST(date_trunc('month', l.l_shipdate) AS DATE) GROUP BY 1, 2"""),
    "cost_distribution": (("cost_bars", "cost_month", "cost_win"), """SELECT b.ts_code, b.trade_date, cost_5pct, cost_15pct, cost_50pct, cost_85pct,
        cost_95pct, weight_avg, winner_rate, his_low, his_high
        FROM cost_bars b LEFT JOIN cost_month m ON b.ts_code = m.ts_code AND b.month = m.month
        LEFT JOIN cost_win x ON b.ts_code = x.ts_code AND b.trade_date = x.trade_date"""),
    "bars_60m": ((), f"""SELECT {_code('user_id')} AS ts_code, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS trade_time,
        first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low, last(value ORDER BY ts, event_id) AS close,
        CAST(count(*) AS DOUBLE) AS vol, round(sum(value), 2) AS amount FROM events GROUP BY 1, 2"""),
    "calendar": (("li",), "SELECT DISTINCT trade_date FROM li"),
    "cal_ord": (("calendar",), "SELECT trade_date, row_number() OVER (ORDER BY trade_date) - 1 AS ord FROM calendar"),
    "industry_static": ((), f"""SELECT {_code('s_suppkey')} AS ts_code, r_name AS l1_name, n_name AS l2_name,
        n_name || '-' || CAST(s_suppkey % 3 AS VARCHAR) AS l3_name
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "industry_pit": ((), f"""SELECT {_code('l_suppkey')} AS ts_code, {_ymd('d')} AS in_date, {_ymd('next_d')} AS out_date,
        p_type AS l1_name, p_brand AS l2_name, p_brand || '-' || CAST(p_size % 3 AS VARCHAR) AS l3_name
        FROM (SELECT *, lead(d) OVER (PARTITION BY l_suppkey ORDER BY y) AS next_d FROM (
            SELECT l_suppkey, year(l_shipdate) AS y, first(l_partkey ORDER BY {ORD}) AS pk, first(l_shipdate ORDER BY {ORD}) AS d
            FROM lineitem GROUP BY 1, 2)) JOIN part ON pk = p_partkey WHERE (y + l_suppkey) % 5 <> 0"""),
    "industry_iv": (("industry_pit",), """SELECT ts_code, strptime(in_date, '%Y%m%d')::DATE AS in_date,
        strptime(coalesce(out_date, '20991231'), '%Y%m%d')::DATE AS out_date, l1_name, l2_name, l3_name FROM industry_pit"""),
    "stock_basic": ((), f"""SELECT {_code('s_suppkey')} AS ts_code, CASE WHEN s_suppkey % 17 = 0 THEN 'ST' || s_name ELSE s_name END AS name,
        CASE WHEN s_suppkey % 13 <> 0 THEN n_name END AS industry, CASE WHEN s_suppkey % 2 = 0 THEN 'main' ELSE 'growth' END AS market,
        strftime(CAST(d AS DATE) + CAST((s_suppkey % 7) * 60 AS INTEGER), '%Y%m%d') AS list_date
        FROM supplier JOIN (SELECT l_suppkey, min(l_shipdate) AS d FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey"""),
    "fina_indicator": ((), f"""SELECT {_code('l_suppkey')} AS ts_code, {_ymd('o_orderdate')} AS ann_date, {_ymd('ship')} AS end_date,
        o_orderpriority AS report_type, {_METRICS} FROM (
        SELECT l_suppkey, o_orderdate, o_orderpriority, round(sum(o_totalprice), 2) AS tp, round(sum(l_extendedprice), 2) AS ep,
        round(100 * sum(l_discount)) AS d, round(100 * sum(l_tax)) AS t, sum(l_quantity) AS q, count(*) AS n,
        max(l_shipdate) AS ship, max(o_orderstatus) AS st
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3)"""),
    "fina": (("fina_indicator",), f"""SELECT ts_code, strptime(ann_date, '%Y%m%d')::DATE AS ann_date, end_date, report_type, {', '.join(FINANCIAL_COLUMNS)}
        FROM fina_indicator QUALIFY row_number() OVER (PARTITION BY ts_code, ann_date ORDER BY end_date DESC, report_type DESC) = 1"""),
    "contracts": ((), f"""SELECT {_code('p_partkey')} AS ts_code, p_type AS underlying, CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'P' END AS call_put,
        p_retailprice AS exercise_price, f + 30 AS list_date, l - 30 AS delist_date
        FROM (SELECT l_partkey, CAST(min(l_shipdate) AS DATE) AS f, CAST(max(l_shipdate) AS DATE) AS l FROM lineitem GROUP BY 1)
        JOIN part ON l_partkey = p_partkey"""),
    "contract_daily": ((), f"""SELECT {_code('l_partkey')} AS ts_code, CAST(l_shipdate AS DATE) AS trade_date,
        last(l_extendedprice / l_quantity ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_suppkey) AS close,
        first(l_extendedprice / l_quantity ORDER BY l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_suppkey) AS settle,
        sum(l_quantity) AS vol, sum(l_quantity) - 20 AS oi FROM lineitem GROUP BY 1, 2"""),
    "fut_mapping": (("contract_daily",), f"""SELECT p_type AS cont_code, trade_date, last(ts_code ORDER BY vol, ts_code) AS mapping_ts_code
        FROM contract_daily JOIN part ON ts_code = {_code('p_partkey')} GROUP BY 1, 2"""),
    "macro_monthly": ((), """SELECT strftime(o_orderdate, '%Y%m') AS month, round(sum(o_totalprice), 2) AS order_value,
        CAST(count(*) AS DOUBLE) AS order_count, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS DOUBLE) AS closed_count FROM orders GROUP BY 1"""),
    "macro_quarterly": ((), """SELECT strftime(o_orderdate, '%Y') || 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter,
        round(sum(o_totalprice), 2) AS gdp, CAST(count(*) AS DOUBLE) AS gdp_orders FROM orders GROUP BY 1"""),
    "fx_daily": ((), """SELECT upper(event_type) || '.FX' AS ts_code, CAST(ts AS DATE) AS trade_date, min(value) AS bid_close,
        last(value ORDER BY ts, event_id) AS ask_close, count(*) - 5 AS tick_qty, max(ts) AS quote_time_gmt FROM events GROUP BY 1, 2"""),
}


def with_views(names: list[str], body: str, **extra: str) -> str:
    """``WITH`` clause holding the named views, what they need, and extra CTEs in order."""
    ordered: dict[str, None] = {}

    def visit(name: str) -> None:
        for needed in VIEWS[name][0]:
            visit(needed)
        ordered[name] = None

    for name in names:
        visit(name)
    parts = [f"{n} AS ({VIEWS[n][1]})" for n in ordered] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    return (f"WITH {', '.join(parts)} " if parts else "") + body


def rounded(cols: list[str], source: str, keep: list[str] = (), digits: int = 6) -> str:
    """Final projection: doubles rounded, negative zero removed; dates as compact text."""
    half = 0.5 * 10 ** -digits
    outs = list(keep) + [f"CASE WHEN abs({c}) < {half:.10f} THEN 0.0 ELSE round({c}, {digits}) END AS {c}" for c in cols]
    return f"SELECT {', '.join(outs)} FROM {source}"
