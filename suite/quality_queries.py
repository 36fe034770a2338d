"""Deduplication, profiles, coverage, increments, derived tables and scalar functions."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import functions as F

from suite.common import ORACLES, also, query
from suite.domain_queries import A_STEPS, _da, _fa
from suite.factor_queries import KEYS
from suite.library_queries import ymd
from suite.view_sql import rounded as r_sql
from suite.view_sql import with_views
from tidepanel.functions import scalars as sc
from tidepanel.operators import dedup, increments, profile, quality
from tidepanel.plans import derived, domains
from tidepanel.session import cut_lineage, shared_path
from tidepanel.sources import readers, sinks
from tidepanel.sources.specs import SPECS, DatasetSpec

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
_LK = ", ".join(LINE_KEY)


# ------------------------------------------------------------------ deduplication and set operations
def _keep_sql(desc: str) -> str:
    return (f"SELECT {_LK}, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d') AS ship FROM lineitem "
            f"QUALIFY row_number() OVER (PARTITION BY {_LK} ORDER BY {', '.join(c + desc for c in LINE_ORDER)}) = 1")


def _line(df):
    return df.select(*LINE_KEY, "l_partkey", "l_suppkey", F.date_format("l_shipdate", "yyyyMMdd").alias("ship"))


@query("dedup_keep_last", _keep_sql(" DESC"))
def dedup_keep_last(v):
    return _line(dedup.keep_last(v.table("lineitem"), LINE_KEY, LINE_ORDER))


@query("dedup_keep_first", _keep_sql(""))
def dedup_keep_first(v):
    return _line(dedup.keep_first(v.table("lineitem"), LINE_KEY, LINE_ORDER))


@query("dedup_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_suppkey FROM lineitem")
def dedup_distinct_rows(v):
    return dedup.distinct_rows(v.table("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"))


@query("duplicate_report", f"""SELECT CAST(sum(k) AS BIGINT) AS total_rows, CAST(sum(k) - sum(d) AS BIGINT) AS duplicate_rows, CAST(sum(k) - count(*) AS BIGINT) AS duplicate_keys
    FROM (SELECT {_LK}, count(*) AS k, count(DISTINCT (l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate)) AS d FROM lineitem GROUP BY {_LK})""")
def duplicate_report(v):
    return dedup.duplicate_report(v.table("lineitem"), LINE_KEY)


@query("duplicate_report_documents", """SELECT CAST(sum(k) AS BIGINT) AS total_rows, 0::BIGINT AS duplicate_rows, CAST(sum(k) - count(*) AS BIGINT) AS duplicate_keys FROM (SELECT text, count(*) AS k FROM documents GROUP BY text)""")
def duplicate_report_documents(v):
    """Copies of whole texts among the documents (ids differ, so no row is a full copy)."""
    docs = v.table("documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    return dedup.duplicate_report(docs, ["digest"])


@query("union_schema_alignment", """SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderpriority, CAST(NULL AS VARCHAR) AS note FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT o_orderkey, CAST(NULL AS BIGINT), CAST(CAST(o_totalprice AS BIGINT) AS DOUBLE), o_orderpriority, 'open' FROM (SELECT o_orderkey, floor(o_totalprice) AS o_totalprice, o_orderpriority FROM orders WHERE o_orderstatus <> 'F')""")
def union_schema_alignment(v):
    """Parts that drift: an untyped column, a missing column, an extra column, integer for double."""
    o = v.table("orders")
    a = o.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", F.lit(None).alias("note"))
    b = o.where("o_orderstatus <> 'F'").select("o_orderkey", F.floor("o_totalprice").cast("long").alias("o_totalprice"), "o_orderpriority", F.lit("open").alias("note"), F.lit(1).alias("extra"))
    return dedup.union_aligned([a, b])


@query("set_difference_dates", "SELECT strftime(d, '%Y%m%d') AS d, side FROM (SELECT d, 'orders' AS side FROM (SELECT o_orderdate AS d FROM orders EXCEPT SELECT l_shipdate FROM lineitem) UNION ALL SELECT d, 'both' FROM (SELECT o_orderdate AS d FROM orders UNION SELECT l_shipdate FROM lineitem))")
def set_difference_dates(v):
    o, l = v.table("orders").select(F.col("o_orderdate").cast("date").alias("d")), v.table("lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    return dedup.set_difference(o, l, "d").withColumn("side", F.lit("orders")).unionByName(dedup.set_union(o, l, "d").withColumn("side", F.lit("both")))


# ------------------------------------------------------------------ profiles
_NUM = {"region": ["r_regionkey"], "nation": ["n_nationkey", "n_regionkey"], "customer": ["c_custkey", "c_nationkey", "c_acctbal"], "supplier": ["s_suppkey", "s_nationkey", "s_acctbal"],
        "events": ["event_id", "user_id", "value"], "documents": ["doc_id", "n_chars"], "embeddings": ["vec_id", "label"], "pages": ["page_id"], "benchmark": ["item_id"], "labels": ["doc_id", "quality", "toxic"],
        "conversations": ["conv_id", "turn"], "orders": ["o_orderkey", "o_custkey", "o_totalprice"], "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"], "part": ["p_partkey", "p_size", "p_retailprice"]}
_TXT = {"region": [("r_name", "string")], "nation": [("n_name", "string")], "customer": [("c_name", "string"), ("c_mktsegment", "string")], "supplier": [("s_name", "string")],
        "events": [("ts", "timestamp_ntz"), ("event_type", "string"), ("props", "string")], "documents": [("text", "string"), ("lang", "string"), ("source", "string")], "embeddings": [("embedding", "array<float>")],
        "pages": [("url", "string"), ("html", "string")], "benchmark": [("text", "string")], "labels": [], "conversations": [("role", "string"), ("text", "string")], "orders": [("o_orderstatus", "string"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
        "lineitem": [("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")], "part": [("p_name", "string"), ("p_brand", "string"), ("p_type", "string")]}
_PCTS = list(profile.QUANTILES)


def _profile_sql(t: str) -> str:
    parts = []
    for c in _NUM[t]:
        qs = ", ".join(f"max(CASE WHEN i = floor({p} * (n - 1) + 0.5) THEN x END) AS {q}" for q, p in profile.QUANTILES.items())
        parts.append(f"""SELECT '{t}' AS file_name, '{c}' AS "column", count(*) - count(x) AS null_count, round(100.0 * (count(*) - count(x)) / count(*), 4) AS null_pct, count(*) FILTER (WHERE x = 0) AS zero_count,
            round(100.0 * count(*) FILTER (WHERE x = 0) / count(*), 4) AS zero_pct, min(x) AS "min", max(x) AS "max", avg(x) AS mean, stddev_samp(x) AS "std", count(*) FILTER (WHERE isnan(x)) AS nan_count, count(*) FILTER (WHERE isinf(x)) AS inf_count, {qs}
            FROM (SELECT CAST({c} AS DOUBLE) AS x, row_number() OVER (ORDER BY {c} NULLS LAST) - 1 AS i, count({c}) OVER () AS n FROM {t})""")
    nulls = ", ".join(f"CAST(NULL AS DOUBLE) AS {q}" for q in _PCTS)
    for c, _ in _TXT[t]:
        parts.append(f"""SELECT '{t}', '{c}', count(*) - count({c}), round(100.0 * (count(*) - count({c})) / count(*), 4), 0, 0.0, NULL, NULL, NULL, NULL, 0, 0, {nulls} FROM {t}""")
    return " UNION ALL ".join(parts)


_P_KEEP = ["file_name", '"column"', "null_count", "zero_count", "nan_count", "inf_count"]
_P_DBL = ["null_pct", "zero_pct", '"min"', '"max"', "mean", '"std"', *_PCTS]


@query("column_profile", r_sql(_P_DBL, f"({_profile_sql('lineitem')})", _P_KEEP, 4), digits=4)
def column_profile(v):
    return profile.profile(v.table("lineitem"), "lineitem", stored=True).drop("dtype")


@query("column_profile_all_tables", r_sql(_P_DBL, "(" + " UNION ALL ".join(_profile_sql(t) for t in _NUM) + ")", _P_KEEP, 4), digits=4)
def column_profile_all_tables(v):
    return profile.profile_all({t: v.table(t) for t in _NUM}, stored=True).drop("dtype")


_D = "price_volume"
_PV = [*_da, *_fa]


def _pv_sql() -> dict[str, str]:
    union = " UNION ALL ".join(f"SELECT '{c}' AS col, {c} AS x FROM a2" for c in _PV)
    qs = ", ".join(f"max(CASE WHEN i = floor({p} * (n - 1) + 0.5) THEN x END) AS {q}" for q, p in profile.QUANTILES.items())
    return {**A_STEPS, "u": union, "un": "SELECT *, CASE WHEN x IS NOT NULL THEN row_number() OVER (PARTITION BY col ORDER BY x NULLS LAST) - 1 END AS i, count(x) OVER (PARTITION BY col) AS n FROM u",
            "pf": f"SELECT '{_D}' AS file_name, col AS \"column\", round(100 * (count(*) - count(x)) / count(*), 4) AS null_pct, round(100 * count(*) FILTER (WHERE x = 0) / count(*), 4) AS zero_pct, min(x) AS mn, max(x) AS mx, {qs} FROM un GROUP BY col"}


_ISSUE_LEGS = [*[f"{side}_{size}_amount" for size in ("sm", "md", "lg", "elg") for side in ("buy", "sell")], "net_mf_amount"]


@query("profile_rule_issues", with_views(["moneyflow"], r_sql(["null_pct", "zero_pct"], "t WHERE null_pct > 50 OR zero_pct > 90", ["file_name", '"column"'], 4), t=" UNION ALL ".join(
    f"""SELECT 'moneyflow' AS file_name, '{c}' AS "column", round(100.0 * (count(*) - count({c})) / count(*), 4) AS null_pct, round(100.0 * count(*) FILTER (WHERE {c} = 0) / count(*), 4) AS zero_pct FROM moneyflow""" for c in _ISSUE_LEGS)), digits=4)
def profile_rule_issues(v):
    return profile.issues(profile.profile(v.moneyflow().select(*_ISSUE_LEGS), "moneyflow"))


def _price_profile_all(v):
    return profile.profile(domains.price_volume(v.daily_bars(), v.daily_basic(), only=_PV), _D, stored=True)


_PV_ALL_SQL = {**_pv_sql(), "u": " UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS DOUBLE) AS x FROM a2" for c in _PV)}


@query("profile_clipping_suspects_all_columns", with_views(["daily_bars", "daily_basic"], r_sql(['"min"', '"max"', "q01", "q99"], "cl", ['"column"', "file_name", "kind"]), **_PV_ALL_SQL,
    cl="""SELECT "column", file_name, mn AS "min", mx AS "max", q01, q99, CASE WHEN mn = q01 OR mx = q99 THEN 'quantile cut' ELSE 'hard bound' END AS kind FROM pf WHERE mn = q01 OR mx = q99 OR mn = -1.0 OR mx = 1.0"""))
def profile_clipping_suspects_all_columns(v):
    return profile.clipping_suspects(_price_profile_all(v))


also("profile_clipping_suspects_all_columns", "profile_clipping_suspects")


@query("profile_high_zero_and_null_all_columns", with_views(["daily_bars", "daily_basic"], r_sql(["pct"], "h", ["kind", '"column"'], 4), **_PV_ALL_SQL,
    h="""SELECT 'zero' AS kind, "column", zero_pct AS pct FROM pf WHERE zero_pct > 15 UNION ALL SELECT 'null', "column", null_pct FROM pf WHERE null_pct > 10"""), digits=4)
def profile_high_zero_and_null_all_columns(v):
    prof = _price_profile_all(v)
    zero = profile.high_zero(prof).select(F.lit("zero").alias("kind"), "column", F.col("zero_pct").alias("pct"))
    return zero.unionByName(profile.high_null(prof).select(F.lit("null").alias("kind"), "column", F.col("null_pct").alias("pct")))


also("profile_high_zero_and_null_all_columns", "profile_high_zero_and_null")


@query("raw_vs_processed_bounds", with_views(["daily_bars", "daily_basic"], r_sql(["bound_share", "raw_zero_share", "processed_zero_share"], "t", ["raw", "processed"]), **A_STEPS,
    t=" UNION ALL ".join(f"""SELECT '{m}_raw' AS raw, '{m}_robust' AS processed, count(*) FILTER (WHERE {m}_robust IN (lo, hi)) / count({m}_robust) AS bound_share,
    count(*) FILTER (WHERE {m}_raw = 0) / count({m}_raw) AS raw_zero_share, count(*) FILTER (WHERE {m}_robust = 0) / count({m}_robust) AS processed_zero_share
    FROM a2, (SELECT min({m}_robust) AS lo, max({m}_robust) AS hi FROM a2)""" for m in ("ret_cc_1d", "gap_open"))))
def raw_vs_processed_bounds(v):
    table = domains.price_volume(v.daily_bars(), v.daily_basic())
    return profile.bound_shares(table, {"ret_cc_1d_raw": "ret_cc_1d_robust", "gap_open_raw": "gap_open_robust"})


_CAT = [("o_orderkey", "bigint", 1), ("o_custkey", "bigint", 1), ("o_orderstatus", "string", 0), ("o_totalprice", "double", 1), ("o_orderdate", "timestamp_ntz", 2), ("o_orderpriority", "string", 0)]


@query("column_catalog", " UNION ALL ".join(f"""SELECT 'orders' AS file_name, '{c}' AS "column", 'Dynamic Continuous' AS category, '{t}' AS dtype, CAST(min({c}) AS VARCHAR) AS example_value,
    (count(*) - count({c})) / count(*) AS missing_rate, {f"CAST(CAST(min({c}) AS DOUBLE) AS VARCHAR)" if n == 1 else f"CAST(min({c}) AS VARCHAR)"} AS range_low, {f"CAST(CAST(max({c}) AS DOUBLE) AS VARCHAR)" if n == 1 else f"CAST(max({c}) AS VARCHAR)"} AS range_high,
    'Field {c} from orders' AS description FROM orders""" for c, t, n in _CAT))
def column_catalog(v):
    return profile.catalog(v.table("orders"), "orders")


_HC = _NUM["lineitem"]


@query("histogram_50_bins", " UNION ALL ".join(f"""SELECT '{c}' AS "column", CAST(least(floor(({c} - lo) / (hi - lo) * 50), 49) AS BIGINT) AS bin, count(*) AS rows
    FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) GROUP BY 2""" for c in _HC))
def histogram_50_bins(v):
    return profile.histogram(v.table("lineitem"))


_GRP = {t: g for g, ts in {"facts": "orders lineitem events", "dimensions": "region nation customer supplier part", "text": "documents embeddings pages benchmark labels conversations"}.items() for t in ts.split()}


@query("group_totals", 'SELECT "group", count(*) AS files, CAST(sum(n) AS BIGINT) AS rows FROM (' + " UNION ALL ".join(f"SELECT '{g}' AS \"group\", count(*) AS n FROM {t}" for t, g in _GRP.items()) + ") GROUP BY 1")
def group_totals(v):
    return profile.group_totals({t: v.table(t) for t in _GRP}, _GRP).drop("size_mb")


# ------------------------------------------------------------------ coverage and contracts
_COV = "(SELECT DISTINCT o_orderdate AS d FROM orders) e FULL JOIN (SELECT DISTINCT l_shipdate AS d FROM lineitem) g ON e.d = g.d"


@query("date_coverage_report", f"""SELECT count(e.d) AS expected, count(g.d) AS present, count(*) FILTER (WHERE g.d IS NULL) AS missing, count(*) FILTER (WHERE e.d IS NULL) AS extra,
    strftime(min(e.d) FILTER (WHERE g.d IS NULL), '%Y%m%d') AS first_missing, strftime(max(e.d) FILTER (WHERE g.d IS NULL), '%Y%m%d') AS last_missing FROM {_COV}""")
def date_coverage_report(v):
    return quality.coverage_report(*_dates(v), "d")


def _dates(v):
    return v.table("orders").select(F.col("o_orderdate").cast("date").alias("d")), v.table("lineitem").select(F.col("l_shipdate").cast("date").alias("d"))


@query("date_coverage_gaps", f"SELECT strftime(coalesce(e.d, g.d), '%Y%m%d') AS d, CASE WHEN g.d IS NULL THEN 'missing' ELSE 'extra' END AS kind FROM {_COV} WHERE e.d IS NULL OR g.d IS NULL")
def date_coverage_gaps(v):
    return quality.coverage_gaps(*_dates(v), "d")


_PLANTED_BARS = {"pb": "SELECT ts_code, trade_date, open, close FROM daily_bars UNION ALL SELECT ts_code, NULL, open, close FROM daily_bars WHERE ts_code LIKE '%1' UNION ALL SELECT ts_code, trade_date, open, close FROM daily_bars WHERE ts_code LIKE '%2'"}
_CONTRACT = """SELECT '{d}' AS dataset, '{absent}' AS absent_columns, count(*) AS rows, count(*) FILTER (WHERE ts_code IS NULL OR trade_date IS NULL) AS null_keys,
    count(*) - (SELECT count(*) FROM (SELECT DISTINCT ts_code, trade_date FROM pb)) AS surplus_keys FROM pb"""


@query("dataset_contract_check", with_views(["daily_bars"], _CONTRACT.format(d="stock_daily", absent="") + " UNION ALL " + _CONTRACT.format(d="fx_daily", absent="bid_close,ask_close"), **_PLANTED_BARS))
def dataset_contract_check(v):
    """Bars with rows that lack a date and rows that stand twice, held against two contracts."""
    bars = v.daily_bars().select("ts_code", "trade_date", "open", "close")
    undated = bars.where("ts_code LIKE '%1'").withColumn("trade_date", F.lit(None).cast("date"))
    planted = bars.unionByName(undated).unionByName(bars.where("ts_code LIKE '%2'"))
    return dedup.union_all(*[quality.contract_violations(planted, SPECS[d]) for d in ("stock_daily", "fx_daily")])


@query("bar_extent", with_views(["bars_60m"], "SELECT count(DISTINCT ts_code) AS entities, count(DISTINCT trade_time) AS dates, count(*) AS rows FROM bars_60m"))
def bar_extent(v):
    return quality.distinct_extent(v.bars_60m(), time="trade_time")


@query("compaction_check", with_views(["daily_bars"], "SELECT count(*) AS rows, strftime(min(trade_date), '%Y%m%d') AS first_date, strftime(max(trade_date), '%Y%m%d') AS last_date, 'suspend_timing' AS empty_columns FROM daily_bars"))
def compaction_check(v):
    return quality.compaction_check(v.daily_bars().withColumn("suspend_timing", F.lit(None).cast("string")), "trade_date")


_CRIT = ["pre_close", "close", "amount"]


@query("critical_null_counts", with_views(["daily_bars"], " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM daily_bars" for c in _CRIT)))
def critical_null_counts(v):
    return quality.null_counts(v.daily_bars(), _CRIT)


@query("content_fingerprint_counts", """SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS unique_keys, strftime(max(o_orderdate), '%Y%m%d') AS last_date,
    (SELECT count(*) FROM (DESCRIBE orders)) AS columns FROM orders""")
def content_fingerprint_counts(v):
    """The part of the fingerprint that SQL can express."""
    return content_fingerprint(v).drop("content_hash")


@query("content_fingerprint")
def content_fingerprint(v):
    """The hash has no SQL form; a test recomputes it in Python from the same rows."""
    o = v.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return quality.fingerprint(o, ["o_orderkey"], "o_orderdate")


# ------------------------------------------------------------------ options, futures, macro, fx
def _rules_sql(src: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS rule, CAST(coalesce({e}, 0) AS BIGINT) AS violations FROM {src}" for n, e in rules.items())


def _cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


_LIFE = {"before_listing": _cnt("trade_date < list_date"), "after_delisting": _cnt("trade_date > delist_date"), "negative_oi": _cnt("oi < 0"), "negative_vol": _cnt("vol < 0")}


@query("option_lifecycle_checks", with_views(["contract_daily", "contracts"], _rules_sql("pd d JOIN contracts c ON d.ts_code = c.ts_code", _LIFE) + " UNION ALL " + _rules_sql("pd", {"surplus_key": "count(*) - count(DISTINCT (ts_code, trade_date))"}),
    pd="SELECT ts_code, trade_date, vol, oi FROM contract_daily UNION ALL SELECT ts_code, trade_date, -vol, oi FROM contract_daily WHERE vol >= 45"))
def option_lifecycle_checks(v):
    """Quotes of a large volume stand once more with a negative one."""
    daily = v.contract_daily().select("ts_code", "trade_date", "vol", "oi")
    return quality.option_lifecycle(daily.unionByName(daily.where("vol >= 45").withColumn("vol", -F.col("vol"))), v.contracts())


@query("option_strike_gaps", with_views(["contracts"], r_sql(["max_step", "min_step"], "g", ["underlying", "call_put", "strikes"]), g="""SELECT underlying, call_put, count(*) AS strikes, max(step) AS max_step, min(step) AS min_step FROM (
    SELECT *, exercise_price - lag(exercise_price) OVER (PARTITION BY underlying, call_put ORDER BY exercise_price) AS step FROM (SELECT DISTINCT underlying, call_put, exercise_price FROM contracts)) GROUP BY 1, 2"""))
def option_strike_gaps(v):
    return quality.strike_gaps(v.contracts())


@query("option_chain_active", with_views(["contract_daily", "contracts"], f"SELECT d.ts_code, {ymd('trade_date')}, close, call_put, exercise_price, underlying FROM contract_daily d JOIN contracts c ON d.ts_code = c.ts_code WHERE trade_date BETWEEN list_date AND delist_date"), exact=("close", "exercise_price"))
def option_chain_active(v):
    return derived.option_chain(v.contract_daily(), v.contracts()).select("ts_code", "trade_date", "close", "call_put", "exercise_price", "underlying")


@query("option_active_counts", with_views(["contracts", "calendar"], f"""SELECT {ymd('trade_date')}, s.call_put, count(c.ts_code) AS active FROM calendar CROSS JOIN (SELECT DISTINCT call_put FROM contracts) s
    LEFT JOIN contracts c ON c.call_put = s.call_put AND trade_date BETWEEN list_date AND delist_date GROUP BY 1, 2"""))
def option_active_counts(v):
    return derived.active_contracts(v.contracts(), v.calendar())


_MONEY = """SELECT underlying, trade_date, call_put, close, CASE WHEN abs((close - exercise_price) / nullif(exercise_price, 0)) <= 0.05 THEN 'ATM'
    WHEN CASE WHEN call_put = 'C' THEN close > exercise_price ELSE close < exercise_price END THEN 'ITM' ELSE 'OTM' END AS moneyness
    FROM contract_daily d JOIN contracts c ON d.ts_code = c.ts_code WHERE trade_date BETWEEN list_date AND delist_date"""


@query("option_moneyness_pivot", with_views(["contract_daily", "contracts"], r_sql(["C", "P"], "p", ["underlying", "moneyness"], 4), m=_MONEY,
    p="SELECT underlying, moneyness, avg(close) FILTER (WHERE call_put = 'C') AS C, avg(close) FILTER (WHERE call_put = 'P') AS P FROM m GROUP BY 1, 2"), digits=4)
def option_moneyness_pivot(v):
    chain = derived.option_chain(v.contract_daily(), v.contracts())
    return derived.chain_pivot(derived.moneyness(chain, "close"), ["underlying", "moneyness"], "close")


@query("futures_mapping_check", with_views(["fut_mapping", "contract_daily"], f"""SELECT cont_code, {ymd('trade_date')}, count(DISTINCT m) AS contracts FROM (SELECT cont_code, trade_date, mapping_ts_code AS m FROM fut_mapping
    UNION ALL SELECT p_type, trade_date, ts_code FROM contract_daily JOIN part ON ts_code = lpad(CAST(p_partkey AS VARCHAR), 10, '0') WHERE vol >= 45) GROUP BY cont_code, trade_date HAVING count(DISTINCT m) > 1"""))
def futures_mapping_check(v):
    """Main mapping plus a rival one (every contract with volume 45 or more)."""
    types = v.table("part").select(F.lpad(F.col("p_partkey").cast("string"), 10, "0").alias("ts_code"), F.col("p_type").alias("cont_code"))
    rival = v.contract_daily().where("vol >= 45").join(types, "ts_code").select("cont_code", "trade_date", F.col("ts_code").alias("mapping_ts_code"))
    return quality.ambiguous_mappings(v.fut_mapping().unionByName(rival))


@query("futures_continuous_price", with_views(["fut_mapping", "contract_daily"], f"SELECT cont_code, m.mapping_ts_code, {ymd('trade_date').replace('(trade_date', '(m.trade_date')}, close, vol FROM fut_mapping m LEFT JOIN contract_daily d ON m.mapping_ts_code = d.ts_code AND m.trade_date = d.trade_date"), exact=("close", "vol"))
def futures_continuous_price(v):
    return derived.continuous_price(v.fut_mapping(), v.contract_daily())


@query("contract_prefix_filter", with_views(["contracts"], "SELECT ts_code, underlying FROM contracts WHERE starts_with(ts_code, '00000001') OR starts_with(ts_code, '00000003')"))
def contract_prefix_filter(v):
    return derived.mapped_contracts(v.contracts(), ["00000001", "00000003"]).select("ts_code", "underlying")


_ML = """SELECT series_id, 'M' AS frequency, month AS period, 'level' AS value_type, value, last_day(strptime(month || '01', '%Y%m%d')::DATE) + 15 AS release_date FROM (UNPIVOT (SELECT month, order_value, order_count, coalesce(closed_count, -1) AS closed_count FROM macro_monthly) ON order_value, order_count, closed_count INTO NAME series_id VALUE value)
    UNION ALL SELECT series_id, 'Q', quarter, 'level', value, last_day(strptime(substr(quarter, 1, 4) || lpad(CAST(CAST(substr(quarter, 6, 1) AS INTEGER) * 3 AS VARCHAR), 2, '0') || '01', '%Y%m%d')::DATE) + 15 FROM (UNPIVOT (SELECT quarter, gdp, gdp_orders FROM macro_quarterly) ON gdp, gdp_orders INTO NAME series_id VALUE value)"""
_MLONG = {"ml0": _ML, "ml": "SELECT * REPLACE (nullif(value, -1) AS value) FROM ml0"}


def _macro_long(v):
    return derived.macro_long(v.macro_monthly(), "month", "M").unionByName(derived.macro_long(v.macro_quarterly(), "quarter", "Q"))


@query("macro_long_table", with_views(["macro_monthly", "macro_quarterly"], r_sql(["value"], "ml", ["series_id", "frequency", "period", "value_type", ymd("release_date")], 2), **_MLONG), digits=2)
def macro_long_table(v):
    return _macro_long(v)


_SERIES = ["closed_count", "gdp", "gdp_orders", "order_count", "order_value"]


@query("macro_asof_panel_all_series", with_views(["macro_monthly", "macro_quarterly", "calendar"], r_sql(_SERIES, "t", [ymd("trade_date")], 2), **_MLONG,
    t="SELECT c.trade_date, " + ", ".join(f"{s}.value AS {s}" for s in _SERIES) + " FROM calendar c " + " ".join(f"ASOF LEFT JOIN (SELECT * FROM ml WHERE series_id = '{s}') {s} ON c.trade_date >= {s}.release_date" for s in _SERIES)), digits=2)
def macro_asof_panel_all_series(v):
    """The series are those of the table: at most one a column of the wide tables."""
    long = _macro_long(v)
    return derived.macro_asof(v.calendar(), long, sorted(r["series_id"] for r in long.select("series_id").distinct().collect()))


also("macro_asof_panel_all_series", "macro_asof_panel")


@query("macro_series_checks", with_views(["macro_monthly", "macro_quarterly"], _rules_sql("pm", {"bad_period": _cnt("NOT regexp_full_match(period, CASE frequency WHEN 'M' THEN '[0-9]{4}(0[1-9]|1[0-2])' ELSE '[0-9]{4}Q[1-4]' END)"), "future_period": _cnt("CASE WHEN period LIKE '____Q_' THEN CAST(left(period, 4) AS INTEGER) * 12 + 3 * CAST(right(period, 1) AS INTEGER) ELSE CAST(left(period, 4) AS INTEGER) * 12 + CAST(right(period, 2) AS INTEGER) END > 2001 * 12 + 6"), "recent_null": _cnt("value IS NULL AND CASE WHEN period LIKE '____Q_' THEN CAST(left(period, 4) AS INTEGER) * 12 + 3 * CAST(right(period, 1) AS INTEGER) ELSE CAST(left(period, 4) AS INTEGER) * 12 + CAST(right(period, 2) AS INTEGER) END >= 2001 * 12 + 1"), "surplus_key": "count(*) - count(DISTINCT (series_id, value_type, period))"}), **_MLONG,
    pm="SELECT * FROM ml UNION ALL SELECT * REPLACE ('M' AS frequency) FROM ml WHERE frequency = 'Q'"))
def macro_series_checks(v):
    """The quarterly series stand a second time, called monthly."""
    long = _macro_long(v)
    return quality.macro_checks(long.unionByName(long.where("frequency = 'Q'").withColumn("frequency", F.lit("M"))), "200106", "200101")


_PLANTED_FX = {"pf": """SELECT ts_code, trade_date, bid_close, ask_close, tick_qty, quote_time_gmt FROM fx_daily
    UNION ALL SELECT ts_code, trade_date, ask_close + 1, bid_close, tick_qty - 1000000, NULL FROM fx_daily WHERE day(trade_date) % 3 = 0"""}


@query("fx_quote_checks", with_views(["fx_daily"], _rules_sql("pf", {"ask_below_bid": _cnt("ask_close < bid_close"), "negative_ticks": _cnt("tick_qty < 0"), "no_gmt_stamp": _cnt("quote_time_gmt IS NULL"), "surplus_key": "count(*) - count(DISTINCT (ts_code, trade_date))"}), **_PLANTED_FX))
def fx_quote_checks(v):
    """Every third day's quotes once more, with swapped sides, negative ticks and no stamp."""
    fx = v.fx_daily().select("ts_code", "trade_date", "bid_close", "ask_close", "tick_qty", "quote_time_gmt")
    stamp = fx.schema["quote_time_gmt"].dataType
    bad = fx.where(F.dayofmonth("trade_date") % 3 == 0).select(
        "ts_code", "trade_date", (F.col("ask_close") + 1).alias("bid_close"), F.col("bid_close").alias("ask_close"), (F.col("tick_qty") - 1_000_000).alias("tick_qty"), F.lit(None).cast(stamp).alias("quote_time_gmt"))
    return quality.fx_checks(fx.unionByName(bad))


@query("fx_on_local_calendar_all_pairs", with_views(["fx_daily"], f"SELECT t.ts_code, {ymd('trade_date')}, bid_close, ask_close, {ymd('known_on')} FROM t",
    k="SELECT ts_code, trade_date + CASE WHEN hour(quote_time_gmt) >= 22 THEN 1 ELSE 0 END AS known_on, quote_time_gmt, bid_close, ask_close FROM fx_daily",
    kl="SELECT * FROM k QUALIFY row_number() OVER (PARTITION BY ts_code, known_on ORDER BY quote_time_gmt DESC) = 1",
    g="SELECT d.trade_date, p.ts_code FROM (SELECT DISTINCT CAST(ts AS DATE) AS trade_date FROM events) d, (SELECT DISTINCT ts_code FROM fx_daily) p",
    t="SELECT g.ts_code, g.trade_date, bid_close, ask_close, known_on FROM g ASOF LEFT JOIN kl ON g.ts_code = kl.ts_code AND g.trade_date >= kl.known_on"), exact=("bid_close", "ask_close"))
def fx_on_local_calendar_all_pairs(v):
    """The pairs are those of the quotes; their number is bounded by the symbol dimension."""
    cal = v.table("events").select(F.col("ts").cast("date").alias("trade_date"))
    pairs = sorted(r["ts_code"] for r in v.fx_daily().select("ts_code").distinct().where("ts_code IS NOT NULL").collect())
    return derived.fx_on_calendar(v.fx_daily(), cal, 22, pairs).select("ts_code", "trade_date", "bid_close", "ask_close", "known_on")


also("fx_on_local_calendar_all_pairs", "fx_on_local_calendar")


@query("fx_symbol_dimension", "SELECT DISTINCT upper(event_type) || '.FX' AS ts_code, CASE WHEN event_type LIKE '%i%' THEN 'FX' ELSE 'INDEX' END AS classify FROM events WHERE event_type LIKE '%i%' AND (contains(upper(event_type), 'CL') OR contains(upper(event_type), 'VI'))")
def fx_symbol_dimension(v):
    kind = F.when(F.col("event_type").contains("i"), "FX").otherwise("INDEX")
    symbols = v.table("events").select(F.concat(F.upper("event_type"), F.lit(".FX")).alias("ts_code"), kind.alias("classify")).distinct()
    return derived.fx_symbols(symbols, ["FX"], ["CL", "VI"])


@query("contract_allow_list_fallback", "SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS ts_code FROM part WHERE p_brand = 'Brand#7' UNION ALL SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') FROM part WHERE contains(p_name, 'bolt')")
def contract_allow_list_fallback(v):
    """A name filter without hits falls back to the configured brand; one with hits does not."""
    part = v.table("part").select(F.lpad(F.col("p_partkey").cast("string"), 10, "0").alias("ts_code"), "p_name", "p_brand")
    configured = part.where("p_brand = 'Brand#7'").select("ts_code")
    miss = part.where(sc.contains_any("p_name", ["no such name"])).select("ts_code")
    hit = part.where(sc.contains_any("p_name", ["bolt"])).select("ts_code")
    return derived.or_configured(miss, configured).unionByName(derived.or_configured(hit, configured))


# ------------------------------------------------------------------ increments
@query("tasks_per_trade_date", with_views(["calendar"], """SELECT dataset, params, sha1(dataset || '|' || params) AS task_key, sha1(params) AS params_hash FROM (SELECT d AS dataset, '{"trade_date":"' || strftime(trade_date, '%Y%m%d') || '"}' AS params FROM calendar, (SELECT unnest(['stock_daily', 'stock_moneyflow']) AS d))"""))
def tasks_per_trade_date(v):
    return increments.trade_date_tasks(v.calendar(), [SPECS["stock_daily"], SPECS["stock_moneyflow"]])


@query("tasks_per_code_year", """SELECT dataset, params, sha1(dataset || '|' || params) AS task_key, sha1(params) AS params_hash FROM (SELECT 'cffex_fut_daily' AS dataset, '{"end_date":"' || strftime(least(make_date(y, 12, 31), DATE '1999-03-31'), '%Y%m%d') || '","start_date":"' ||
    strftime(greatest(make_date(y, 1, 1), DATE '1996-02-15'), '%Y%m%d') || '","ts_code":"' || lpad(CAST(s_suppkey AS VARCHAR), 10, '0') || '"}' AS params FROM supplier, (SELECT CAST(unnest(range(1996, 2000)) AS INTEGER) AS y))""")
def tasks_per_code_year(v):
    return increments.code_year_tasks(v.stock_basic(), SPECS["cffex_fut_daily"], "19960215", "19990331")


@query("pending_tasks", with_views(["calendar", "moneyflow"], """SELECT params FROM (SELECT '{"trade_date":"' || strftime(c.trade_date, '%Y%m%d') || '"}' AS params FROM calendar c WHERE NOT EXISTS (SELECT 1 FROM moneyflow m WHERE m.trade_date = c.trade_date AND m.buy_elg_amount > 9500))"""))
def pending_tasks(v):
    planned = increments.trade_date_tasks(v.calendar(), [SPECS["stock_moneyflow"]])
    done = increments.trade_date_tasks(v.moneyflow().where("buy_elg_amount > 9500"), [SPECS["stock_moneyflow"]])
    return increments.pending(planned, done).select("params")


@query("task_ledger_state", "SELECT CAST(o_custkey AS VARCHAR) AS task_key, strftime(o_orderdate, '%Y%m%d') AS updated_at, o_orderstatus AS status, o_orderkey AS rows FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def task_ledger_state(v):
    """Orders as an append-only ledger: customer is the task, order date the update time."""
    ledger = v.table("orders").select(
        F.col("o_custkey").cast("string").alias("task_key"), F.col("o_orderdate").cast("date").alias("updated_at"), F.col("o_orderstatus").alias("status"), F.col("o_orderkey").alias("rows")
    )
    return increments.ledger_state(ledger, "rows")


@query("resume_dates", "SELECT l_suppkey, strftime(max(l_shipdate), '%Y%m%d') AS resume_date FROM lineitem GROUP BY 1")
def resume_dates(v):
    return increments.resume_dates(v.table("lineitem"), "l_suppkey", "l_shipdate")


@query("table_extents", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows, strftime(max({c}), '%Y%m%d') AS last_date FROM {t}" for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))))
def table_extents(v):
    """From the files' footers; the timestamps are never read."""
    parts = [readers.dataset_extent(v.spark, f"{v.root}/{t}.parquet", c).withColumn("name", F.lit(t)) for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))]
    return dedup.union_all(*parts)


@query("table_extents_by_scan", ORACLES["table_extents"])
def table_extents_by_scan(v):
    parts = [readers.table_extent(v.table(t), c).withColumn("name", F.lit(t)) for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))]
    return dedup.union_all(*parts)


@query("table_lineage")
def table_lineage(v):
    """Rows, columns and checksum of every file of three tables; tests hash the files outside Spark."""
    parts = [increments.lineage(v.spark, f"{v.root}/{t}.parquet", t, t, "1").drop("fetched_at") for t in ("orders", "lineitem", "documents")]
    return dedup.union_all(*parts).withColumn("path", F.regexp_extract("path", "[^/]+$", 0))


@query("latest_snapshot_rows", "SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y%m') AS snapshot_date FROM orders WHERE strftime(o_orderdate, '%Y%m') = (SELECT max(strftime(o_orderdate, '%Y%m')) FROM orders)")
def latest_snapshot_rows(v):
    return readers.latest_snapshot(v.table("orders").select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyyMM").alias("snapshot_date")))


@query("listed_codes_and_members", with_views(["industry_pit", "stock_basic"], "SELECT s.ts_code, list_date, in_date, coalesce(out_date, '20991231') AS out_date FROM stock_basic s JOIN industry_pit i ON s.ts_code = i.ts_code"))
def listed_codes_and_members(v):
    return readers.listed_codes(v.stock_basic()).join(readers.industry_members(v.industry_pit()).select("ts_code", "in_date", "out_date"), "ts_code")


@query("compact_bar_parts", with_views(["daily_bars"], f"SELECT ts_code, {ymd('trade_date')}, CASE WHEN close < open THEN open ELSE close END AS close, CAST(vol AS DOUBLE) AS vol FROM daily_bars"), exact=("close", "vol"))
def compact_bar_parts(v):
    """Overlapping parts with different columns and types; the first row of each key (by close, descending) is kept."""
    bars = v.daily_bars()
    a = bars.select("ts_code", "trade_date", "close", "vol", (-F.col("close")).alias("seq"))
    b = bars.select("ts_code", "trade_date", F.col("open").alias("close"), F.col("vol").cast("long").alias("vol"), (-F.col("open")).alias("seq"), F.lit("x").alias("extra"))
    return increments.compact([a, b], ["seq"]).drop("seq")


@query("compact_into_touched_months", """SELECT strftime(o_orderdate, '%Y%m') AS month, count(*) AS rows, round(sum(o_totalprice + CASE WHEN month(o_orderdate) = 1 THEN 1 ELSE 0 END), 2) AS price,
    month(o_orderdate) <> 1 AS files_kept FROM orders GROUP BY month(o_orderdate), 1""", digits=2)
def compact_into_touched_months(v):
    """A dataset by month receives corrected rows of every January, twice; the other months' files stay the same ones."""
    path = shared_path(v.spark, f"compact-{uuid.uuid4().hex}")
    orders = v.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice", F.date_format("o_orderdate", "yyyyMM").alias("month"), F.lit(1).alias("version"))
    increments.compact_into(path, orders, ["month"], ["o_orderkey"], ["version"])
    files = lambda: v.spark.read.parquet(path).groupBy(F.col("month").cast("string").alias("month")).agg(F.array_sort(F.collect_set("_metadata.file_path")).alias("f"))
    before = cut_lineage(files())
    late = orders.where(F.month("o_orderdate") == 1).withColumns({"o_totalprice": F.col("o_totalprice") + 1, "version": F.lit(2)})
    increments.compact_into(path, late.unionByName(late), ["month"], ["o_orderkey"], ["version"])
    kept = before.join(files().withColumnRenamed("f", "g"), "month").select("month", (F.col("f") == F.col("g")).alias("files_kept"))
    rows = v.spark.read.parquet(path).groupBy(F.col("month").cast("string").alias("month")).agg(F.count(F.lit(1)).alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("price"))
    return rows.join(kept, "month")


@query("month_code_batches", with_views(["calendar", "stock_basic"], """SELECT month, ts_code, CAST(floor((row_number() OVER (PARTITION BY month ORDER BY ts_code) - 1) / 7) AS BIGINT) AS batch
    FROM (SELECT DISTINCT strftime(trade_date, '%Y%m') AS month FROM calendar) JOIN stock_basic ON month >= substr(list_date, 1, 6)"""))
def month_code_batches(v):
    return increments.month_batches(v.stock_basic(), v.calendar(), 7)


@query("month_batch_keys", with_views(["calendar", "stock_basic"], """SELECT month, batch, count(*) AS codes, month || '_b' || lpad(CAST(batch AS VARCHAR), 5, '0') AS task_key FROM (SELECT month, CAST(floor((row_number() OVER (PARTITION BY month ORDER BY ts_code) - 1) / 7) AS BIGINT) AS batch
    FROM (SELECT DISTINCT strftime(trade_date, '%Y%m') AS month FROM calendar) JOIN stock_basic ON month >= substr(list_date, 1, 6)) GROUP BY 1, 2"""))
def month_batch_keys(v):
    return increments.batch_keys(increments.month_batches(v.stock_basic(), v.calendar(), 7))


# ------------------------------------------------------------------ scalar functions
def _fl(c: str) -> str:
    return f"CAST(coalesce({c}, FALSE) AS INTEGER)"


@query("scalar_arithmetic", f"""SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount >= 1e-4 THEN l_tax / l_discount END, 6) AS safe, round(coalesce(CASE WHEN l_discount >= 1e-4 THEN l_tax / l_discount END, -1), 6) AS safe_filled,
    round(l_tax / (l_discount + 1e-8), 3) AS eps, least(greatest(l_quantity, 10), 40) AS clipped, greatest(l_quantity, 10) AS floored, round(CASE WHEN l_tax > 0 THEN ln(1 + l_tax) END, 6) AS lp, round(ln(1 + greatest(l_quantity - 25, 0)), 6) AS lf,
    greatest(l_quantity, l_linenumber) AS rmax, least(l_quantity, l_linenumber) AS rmin, CASE WHEN l_quantity BETWEEN 1 AND 12 THEN 'sm' WHEN l_quantity <= 38 THEN 'md' ELSE 'lg' END AS size_label, {_fl('l_tax > 0.04')} AS taxed FROM lineitem""")
def scalar_arithmetic(v):
    # eps-division of a zero discount is huge: it is reported with three digits
    return v.table("lineitem").select(
        "l_orderkey", "l_linenumber", sc.safe_div("l_tax", "l_discount").alias("safe"), sc.safe_div("l_tax", "l_discount", fill_value=-1.0).alias("safe_filled"),
        F.round(sc.eps_div("l_tax", "l_discount"), 3).alias("eps"), sc.clip("l_quantity", 10.0, 40.0).alias("clipped"), sc.clip("l_quantity", lower=10.0).alias("floored"),
        sc.log1p_positive("l_tax").alias("lp"), sc.log1p_floor0(F.col("l_quantity") - 25).alias("lf"), sc.row_max("l_quantity", F.col("l_linenumber").cast("double")).alias("rmax"),
        sc.row_min("l_quantity", F.col("l_linenumber").cast("double")).alias("rmin"), sc.interval_label("l_quantity", (1, 12, 38, 50), ("sm", "md", "lg")).alias("size_label"), sc.flag(F.col("l_tax") > 0.04).alias("taxed"))


@query("scalar_dates", """SELECT o_orderkey, strftime(d, '%Y%m%d') AS compact, strftime(d, '%Y-%m-%d') AS iso, strftime(d, '%Y%m') AS month, strftime(d + INTERVAL 7 MONTH, '%Y%m') AS month_p7, strftime(date_trunc('month', d) - INTERVAL 24 MONTH, '%Y%m') AS month_m24,
    strftime(d, '%Y') || 'Q' || quarter(d) AS quarter, strftime(date_trunc('quarter', d) - INTERVAL 24 MONTH, '%Y') || 'Q' || quarter(date_trunc('quarter', d) - INTERVAL 24 MONTH) AS quarter_m8, date_diff('day', DATE '1995-01-01', d) AS age_days, year(d) AS yr,
    CAST((year(d) - 1995) * 4 + quarter(d) - 1 + CASE WHEN d = last_day(d) AND month(d) % 3 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_periods FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def scalar_dates(v):
    d = F.col("o_orderdate").cast("date")
    text = sc.compact_date(d)
    back = sc.parse_date(text)
    month, quarter = sc.month_of(d), sc.quarter_of(d)
    return v.table("orders").select(
        "o_orderkey", sc.iso_to_compact(sc.compact_to_iso(text)).alias("compact"), sc.compact_to_iso(text).alias("iso"), month.alias("month"), sc.shift_month(month, 7).alias("month_p7"), sc.shift_month(month, -24).alias("month_m24"),
        quarter.alias("quarter"), sc.shift_quarter(quarter, -8).alias("quarter_m8"), F.datediff(back, F.lit("1995-01-01").cast("date")).cast("long").alias("age_days"), F.year(back).cast("long").alias("yr"),
        F.size(sc.report_periods(F.lit("1995-01-01").cast("date"), d)).alias("n_periods"))


@query("lookback_ranges", """SELECT o_orderkey, strftime(date_trunc('month', d) - INTERVAL 24 MONTH, '%Y%m') AS start_m, strftime(d, '%Y%m') AS end_m, strftime(date_trunc('quarter', d) - INTERVAL 24 MONTH, '%Y') || 'Q' || quarter(date_trunc('quarter', d) - INTERVAL 24 MONTH) AS start_q, strftime(d, '%Y') || 'Q' || quarter(d) AS end_q FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")
def lookback_ranges(v):
    return v.table("orders").select("o_orderkey", *[c.alias(n) for n, c in increments.lookback(F.col("o_orderdate").cast("date")).items()])


@query("scalar_text_and_hashes", """SELECT p_partkey, starts_with(p_brand, 'Brand#1') OR starts_with(p_brand, 'Brand#25') AS pre, contains(p_name, 'bolt') OR contains(p_name, 'ring') AS has, '{"b":"' || p_brand || '","n":' || p_size || '}' AS js,
    sha1(p_brand || '|' || p_size) AS h, CAST(CAST('0x' || substr(md5(p_name), 1, 8) AS BIGINT) % 16 AS INTEGER) AS shard, coalesce(TRY_CAST(replace(p_brand, 'Brand#', '') AS DOUBLE), 0) AS brand_no FROM part""")
def scalar_text_and_hashes(v):
    return v.table("part").select(
        "p_partkey", sc.starts_with_any("p_brand", ["Brand#1", "Brand#25"]).alias("pre"), sc.contains_any("p_name", ["bolt", "ring"]).alias("has"), sc.canonical_json(n="p_size", b="p_brand").alias("js"),
        sc.stable_hash("p_brand", "p_size").alias("h"), sc.shard_of("p_name", 16).alias("shard"), sc.fill(sc.lenient_double(F.replace("p_brand", F.lit("Brand#"), F.lit(""))), 0.0).alias("brand_no"))


# ------------------------------------------------------------------ sinks, written and read back
_SINKS = {"csv": 1, "json": 1, "zstd": 1, "append": 2, "by_year": 1, "partitioned": 1, "dataset": 1, "parts": 1}


@query("sinks_round_trip", " UNION ALL ".join(f"""SELECT '{n}' AS sink, {k} * count(*) AS rows, CAST({k} * sum(o_orderkey) AS BIGINT) AS keys, round({k} * sum(o_totalprice), 2) AS price, strftime(max(o_orderdate), '%Y%m%d') AS last_date,
    count(DISTINCT o_orderstatus) AS states FROM orders""" for n, k in _SINKS.items()), digits=2)
def sinks_round_trip(v):
    """Every writer gets the whole table; what the readers give back is summed."""
    spark = v.spark
    o = v.table("orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    root = shared_path(spark, f"sinks-{uuid.uuid4().hex}")
    sinks.write_csv_report(o, f"{root}/csv", most_rows=1000)
    sinks.write_json(o, f"{root}/json")
    sinks.write_table(o, f"{root}/zstd", "zstd")
    for _ in range(2):
        sinks.append_table(o, f"{root}/append")
    sinks.write_by_year(o, f"{root}/by_year", "o_orderdate")
    sinks.write_table(o, f"{root}/partitioned", partition_by=["o_orderstatus"])
    layout = DatasetSpec("orders", "orders", "star", "snapshot", ("o_orderkey",), ("o_orderstatus",), None)
    back = {n: spark.read.parquet(f"{root}/{n}") for n in ("zstd", "append", "by_year", "partitioned")}
    back |= {"dataset": spark.read.parquet(sinks.write_dataset(o, f"{root}/sets", layout)), "parts": readers.read_parts(spark, f"{root}/by_year")}
    back |= {"csv": spark.read.schema(o.schema).option("header", "true").csv(f"{root}/csv"), "json": spark.read.schema(o.schema).json(f"{root}/json")}
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"), F.sum("o_totalprice").alias("price"), F.max("o_orderdate").alias("last_date"), F.count_distinct("o_orderstatus").alias("states"))
        .select(F.lit(n).alias("sink"), "*") for n, df in back.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
