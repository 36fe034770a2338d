"""Panel-shaped views over a star schema of orders, line items and events.

A supplier plays the role of an entity and a shipping week the role of a trading
date, so every panel operator can run on the same parquet tables. Each view is built
from exact sums (cents, counts) and single divisions, so any engine computes the same
doubles. Aggregations come before joins: a hot part or order collapses first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.functions.scalars import compact_date, ratio
from tidepanel.operators.pit import shares_and_quantiles
from tidepanel.session import cut_lineage

# The financial columns, in the order the factor library documents them.
FINANCIAL_COLUMNS = [
    "roe", "roe_dt", "q_roe", "q_dt_roe", "roa", "npta", "roic",
    "grossprofit_margin", "netprofit_margin", "profit_to_gr",
    "ocfps", "cfps", "q_ocf_to_sales", "ocf_yoy", "cfps_yoy", "ocf_to_debt", "ocf_to_shortdebt",
    "tr_yoy", "or_yoy", "netprofit_yoy", "dt_netprofit_yoy", "q_sales_yoy", "q_op_qoq", "roe_yoy", "bps_yoy",
    "assets_turn", "ar_turn", "turn_days",
    "debt_to_assets", "current_ratio", "quick_ratio", "cash_ratio", "ebitda", "debt_to_eqt", "tangibleasset_to_debt",
    "invest_capital", "profit_to_op", "interestdebt", "ebit_ps",
]

LEGS = ("sm", "md", "lg", "elg")
COST_POINTS = (5, 15, 50, 85, 95)


def code(key: str) -> Column:
    return F.lpad(F.col(key).cast("string"), 10, "0")


def _week(ts: str) -> Column:
    return F.date_trunc("week", F.col(ts)).cast("date")


def _cents(total: Column) -> Column:
    return F.round(total, 2)


def _price(row: str) -> Column:
    return F.col(f"{row}.l_extendedprice") / F.col(f"{row}.l_quantity")


ROW_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_partkey"]
#: Rows that are equal in these have one price.
PRICE_ORDER = ROW_ORDER[:-1]


@dataclass(frozen=True)
class StarViews:
    spark: SparkSession
    root: str

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    @property
    def width(self) -> int:
        """Upper bound of rows per date: the number of entities (a footer count)."""
        return self.table("supplier").count()

    def staged(self, *names: str, store: Callable[[DataFrame], DataFrame] = cut_lineage, **columns: list[str]) -> StarViews:
        """Same views with the named ones stored once, for jobs that read them repeatedly; ``columns`` names a view's wanted ones."""
        out = StarViews(self.spark, self.root)
        for name in [*names, *columns]:
            frame = getattr(out, name)()
            frame = store(frame.select(*columns[name]) if name in columns else frame)
            object.__setattr__(out, name, lambda frame=frame: frame)
        return out

    def _lines(self) -> DataFrame:
        return self.table("lineitem").withColumns(
            {"ts_code": code("l_suppkey"), "trade_date": _week("l_shipdate"), "price": F.col("l_extendedprice") / F.col("l_quantity")}
        )

    def _cells(self):
        """Line items by supplier and week. Aggregates are keyed by number and order rows by one struct, so that partial ones are narrow."""
        return self.table("lineitem").withColumn("trade_date", _week("l_shipdate")).groupBy("l_suppkey", "trade_date")

    # ------------------------------------------------------------ daily tables
    def daily_bars(self) -> DataFrame:
        rows, price = F.struct(*PRICE_ORDER), F.col("l_extendedprice") / F.col("l_quantity")
        bars = self._cells().agg(
            F.min(rows).alias("first"),
            F.max(rows).alias("last"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.sum("l_quantity").alias("vol"),
            _cents(F.sum("l_extendedprice")).alias("amount"),
        ).select(code("l_suppkey").alias("ts_code"), "trade_date", _price("first").alias("open"), _price("last").alias("close"), "high", "low", "vol", "amount")
        w = Window.partitionBy("ts_code").orderBy("trade_date")
        return bars.withColumn("pre_close", F.lag("close").over(w))

    def daily_basic(self) -> DataFrame:
        keys, cell = ["ts_code", "trade_date"], ["l_suppkey", "trade_date"]
        week = self._cells().agg(
            F.max(F.struct(*PRICE_ORDER)).alias("last"),
            F.sum("l_quantity").alias("vol"),
            _cents(F.sum("l_extendedprice")).alias("amount"),
            _cents(F.sum("l_discount")).alias("disc"),
            _cents(F.sum("l_tax")).alias("tax"),
            F.count(F.lit(1)).alias("n"),
        )
        sold = self.table("lineitem").select("l_suppkey", _week("l_shipdate").alias("trade_date"), F.col("l_partkey").alias("p_partkey"))
        retail = sold.join(self.table("part").select("p_partkey", "p_retailprice"), "p_partkey").groupBy(*cell).agg(_cents(F.sum("p_retailprice")).alias("retail"))
        shares = self.table("supplier").select(code("s_suppkey").alias("ts_code"), (1000 + F.abs("s_acctbal")).alias("total_share"))
        earlier = Window.partitionBy("ts_code").orderBy("trade_date").rowsBetween(-5, -1)
        out = week.withColumn("close", _price("last")).drop("last").join(retail, cell).withColumn("ts_code", code("l_suppkey")).drop("l_suppkey").join(shares, "ts_code")
        out = out.withColumns(
            {
                "pb": F.col("close") / (F.col("retail") / F.col("n")),
                "pe_ttm": ratio(F.col("close"), F.round(100 * F.col("disc"))),
                "ps_ttm": ratio(F.col("amount"), F.round(1000 * F.col("tax"))),
                "dv_ttm": F.round(100 * F.col("disc")) / F.col("n"),
                "turnover_rate_f": F.col("vol") / 10,
                "volume_ratio": ratio(F.col("vol"), F.avg("vol").over(earlier)),
                "float_share": F.col("total_share") * 9 / 10,
                "free_share": (F.col("n") + 2 * F.col("disc")) * F.col("total_share") / (2 * F.col("n")),
            }
        )
        out = out.withColumns({"circ_mv": F.col("close") * F.col("float_share"), "total_mv": F.col("close") * F.col("total_share")})
        return out.select(
            *keys, "close", "turnover_rate_f", "volume_ratio", "pe_ttm", "pb", "ps_ttm", "dv_ttm",
            "total_share", "float_share", "free_share", "total_mv", "circ_mv",
        )

    def moneyflow(self) -> DataFrame:
        """Raw units: a tenth of the currency unit of ``amount``."""
        qty, ext = F.col("l_quantity"), F.col("l_extendedprice")
        leg = F.when(qty <= 12, "sm").when(qty <= 25, "md").when(qty <= 38, "lg").otherwise("elg")
        side = F.when(F.col("l_returnflag") == "R", "sell").otherwise("buy")
        sums = [
            (_cents(F.sum(F.when((leg == size) & (side == s), ext))) / 10).alias(f"{s}_{size}_amount")
            for size in LEGS for s in ("buy", "sell")
        ]
        net = (_cents(F.sum(F.when(side == "sell", -ext).otherwise(ext))) / 10).alias("net_mf_amount")
        return self._lines().groupBy("ts_code", "trade_date").agg(*sums, net)

    def cost_distribution(self) -> DataFrame:
        """Monthly distribution of the exact prices per entity, joined to the weekly closes.

        Percentiles and the share of prices up to the close are
        both read off the running counts of the month's prices and closes in one order.
        """
        keys = ["ts_code", "month"]
        lines = self._lines().withColumn("month", F.date_trunc("month", "l_shipdate").cast("date"))
        average = lines.groupBy(*keys).agg((_cents(F.sum("l_extendedprice")) / F.sum("l_quantity")).alias("weight_avg"))
        bars = self.daily_bars().select("ts_code", "trade_date", "close", "high", "low").withColumn("month", F.trunc("trade_date", "month"))
        so_far = Window.partitionBy("ts_code").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, 0)
        bars = bars.withColumns({"his_low": F.min("low").over(so_far), "his_high": F.max("high").over(so_far)}).drop("high", "low")
        points = {f"cost_{p}pct": p / 100 for p in COST_POINTS}
        return (
            shares_and_quantiles(bars, lines, keys, "price", "close", "share", points).join(average, keys, "left")
            .select("ts_code", "trade_date", *points, "weight_avg", (100 * F.col("share")).alias("winner_rate"), "his_low", "his_high")
        )

    def bars_60m(self) -> DataFrame:
        rows = F.struct("ts", "event_id", "value")
        return (
            self.table("events")
            .groupBy("user_id", F.date_trunc("hour", "ts").alias("hour_start"))
            .agg(
                F.min(rows)["value"].alias("open"), F.max("value").alias("high"), F.min("value").alias("low"),
                F.max(rows)["value"].alias("close"), F.count(F.lit(1)).cast("double").alias("vol"),
                _cents(F.sum("value")).alias("amount"),
            )
            .select(code("user_id").alias("ts_code"), F.date_format("hour_start", "yyyy-MM-dd HH:mm:ss").alias("trade_time"), "open", "high", "low", "close", "vol", "amount")
        )

    # ------------------------------------------------------------ dimensions
    def calendar(self) -> DataFrame:
        return self.table("lineitem").select(_week("l_shipdate").alias("trade_date")).distinct()

    def industry_static(self) -> DataFrame:
        nation = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return self.table("supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
            code("s_suppkey").alias("ts_code"), F.col("r_name").alias("l1_name"), F.col("n_name").alias("l2_name"),
            F.concat_ws("-", F.col("n_name"), (F.col("s_suppkey") % 3).cast("string")).alias("l3_name"),
        )

    def industry_pit(self) -> DataFrame:
        """Yearly membership intervals with gaps; dates as compact text, open end NULL."""
        first = F.min(F.struct(*ROW_ORDER)).alias("f")
        yearly = self.table("lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("y")).agg(first)
        w = Window.partitionBy("l_suppkey").orderBy("y")
        yearly = yearly.select("l_suppkey", "y", F.col("f.l_partkey").alias("p_partkey"), F.col("f.l_shipdate").alias("d")).withColumn(
            "next_d", F.lead("d").over(w)
        )
        kept = yearly.where((F.col("y") + F.col("l_suppkey")) % 5 != 0)
        return kept.join(self.table("part").select("p_partkey", "p_brand", "p_type", "p_size"), "p_partkey").select(
            code("l_suppkey").alias("ts_code"), compact_date("d").alias("in_date"), compact_date("next_d").alias("out_date"),
            F.col("p_type").alias("l1_name"), F.col("p_brand").alias("l2_name"),
            F.concat_ws("-", F.col("p_brand"), (F.col("p_size") % 3).cast("string")).alias("l3_name"),
        )

    def stock_basic(self) -> DataFrame:
        first = self.table("lineitem").groupBy("l_suppkey").agg(F.min("l_shipdate").alias("d"))
        key = F.col("s_suppkey")
        return (
            self.table("supplier").join(first, key == F.col("l_suppkey")).join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .select(
                code("s_suppkey").alias("ts_code"),
                F.when(key % 17 == 0, F.concat(F.lit("ST"), F.col("s_name"))).otherwise(F.col("s_name")).alias("name"),
                F.when(key % 13 != 0, F.col("n_name")).alias("industry"),
                F.when(key % 2 == 0, "main").otherwise("growth").alias("market"),
                compact_date(F.date_add(F.col("d").cast("date"), ((key % 7) * 60).cast("int"))).alias("list_date"),
            )
        )

    # ------------------------------------------------------------ financial reports
    def fina_indicator(self) -> DataFrame:
        """Several reports per entity and announcement date, as text-dated rows."""
        # a hot order is split by the join; rows are dealt by entity while narrow, since all that follows groups and scans by entity
        lines = self.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_suppkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity", "l_shipdate")
        orders = self.table("orders").select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice", "o_orderstatus")
        dealt = lines.join(orders, "o_orderkey").drop("o_orderkey").withColumn("ts_code", code("l_suppkey")).drop("l_suppkey").repartition("ts_code")
        base = dealt.groupBy("ts_code", "o_orderdate", "o_orderpriority").agg(
            _cents(F.sum("o_totalprice")).alias("tp"), _cents(F.sum("l_extendedprice")).alias("ep"),
            F.round(100 * F.sum("l_discount")).alias("d"), F.round(100 * F.sum("l_tax")).alias("t"),
            F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"), F.max("l_shipdate").alias("ship"), F.max("o_orderstatus").alias("st"),
        )
        metrics = [F.expr(financial_metric(i, name)).alias(name) for i, name in enumerate(FINANCIAL_COLUMNS)]
        return base.select(
            "ts_code", compact_date("o_orderdate").alias("ann_date"), compact_date("ship").alias("end_date"),
            F.col("o_orderpriority").alias("report_type"), *metrics,
        )

    # ------------------------------------------------------------ contracts, macro, fx
    def contracts(self) -> DataFrame:
        """Part as derivative contract: life span inside its traded dates."""
        span = self.table("lineitem").groupBy("l_partkey").agg(
            F.min("l_shipdate").cast("date").alias("first"), F.max("l_shipdate").cast("date").alias("last")
        )
        return span.join(self.table("part"), F.col("l_partkey") == F.col("p_partkey")).select(
            code("p_partkey").alias("ts_code"), F.col("p_type").alias("underlying"),
            F.when(F.col("p_partkey") % 2 == 0, "C").otherwise("P").alias("call_put"),
            F.col("p_retailprice").alias("exercise_price"),
            F.date_add("first", 30).alias("list_date"), F.date_sub("last", 30).alias("delist_date"),
        )

    def contract_daily(self) -> DataFrame:
        order = F.struct("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_suppkey")
        return (
            self.table("lineitem").withColumn("price", F.col("l_extendedprice") / F.col("l_quantity"))
            .groupBy(code("l_partkey").alias("ts_code"), F.col("l_shipdate").cast("date").alias("trade_date"))
            .agg(
                F.max_by("price", order).alias("close"), F.min_by("price", order).alias("settle"),
                F.sum("l_quantity").alias("vol"), (F.sum("l_quantity") - 20).alias("oi"),
            )
        )

    def fut_mapping(self) -> DataFrame:
        """Continuous code (part type) -> the month contract with the largest volume of the date."""
        best = self.contract_daily().join(self.table("part").select(code("p_partkey").alias("ts_code"), "p_type"), "ts_code").groupBy(
            F.col("p_type").alias("cont_code"), "trade_date"
        ).agg(F.max(F.struct("vol", "ts_code")).alias("b"))
        return best.select("cont_code", "trade_date", F.col("b.ts_code").alias("mapping_ts_code"))

    def macro_monthly(self) -> DataFrame:
        o = self.table("orders")
        return o.groupBy(F.date_format("o_orderdate", "yyyyMM").alias("month")).agg(
            _cents(F.sum("o_totalprice")).alias("order_value"), F.count(F.lit(1)).cast("double").alias("order_count"),
            F.sum(F.when(F.col("o_orderstatus") == "F", 1)).cast("double").alias("closed_count"),
        )

    def macro_quarterly(self) -> DataFrame:
        o = self.table("orders")
        quarter = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("Q"), F.quarter("o_orderdate").cast("string"))
        return o.groupBy(quarter.alias("quarter")).agg(
            _cents(F.sum("o_totalprice")).alias("gdp"), F.count(F.lit(1)).cast("double").alias("gdp_orders")
        )

    def fx_daily(self) -> DataFrame:
        """Event type as currency pair: daily first/last quote stamped in GMT."""
        order = F.struct("ts", "event_id")
        return (
            self.table("events").groupBy(F.concat(F.upper("event_type"), F.lit(".FX")).alias("ts_code"), F.col("ts").cast("date").alias("trade_date"))
            .agg(
                F.min("value").alias("bid_close"), F.max_by("value", order).alias("ask_close"),
                (F.count(F.lit(1)) - 5).alias("tick_qty"), F.max("ts").alias("quote_time_gmt"),
            )
        )


def financial_metric(i: int, name: str) -> str:
    """Arithmetic both engines evaluate to the same double; some metrics are made missing or zero."""
    body = f"(ep * {10 + i % 7}) / (tp * {11 + i % 5}) + (d * {i % 4} - t * {i % 3}) / (q * {2 + i % 6})"
    if name == "roe_dt":
        return f"case when st <> 'F' then {body} end"
    if name == "ebitda":
        return f"case when d > 0 then {body} end"
    if name == "interestdebt":
        return f"case when n % 4 = 0 then 0 * ep else {body} end"
    return body
