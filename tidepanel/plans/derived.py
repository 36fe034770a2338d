"""Derived tables for macro series, options, futures and currencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.scalars import contains_any, starts_with_any
from tidepanel.operators.pit import asof_join, within_life


# ---------------------------------------------------------------- macro
def macro_long(wide: DataFrame, period: str, frequency: str, value_type: str = "level", lag_days: int = 15) -> DataFrame:
    """Long series table with the release date of every observation."""
    values = [c for c in wide.columns if c != period]
    long = wide.unpivot([period], values, "series_id", "value").withColumnRenamed(period, "period")
    if frequency == "M":
        end = F.last_day(F.to_date(F.concat("period", F.lit("01")), "yyyyMMdd"))
    else:
        month = F.lpad((F.substring("period", 6, 1).cast("int") * 3).cast("string"), 2, "0")
        end = F.last_day(F.to_date(F.concat(F.substring("period", 1, 4), month, F.lit("01")), "yyyyMMdd"))
    return long.select("series_id", F.lit(frequency).alias("frequency"), "period", F.lit(value_type).alias("value_type"), "value", F.date_add(end, lag_days).alias("release_date"))


def macro_asof(panel: DataFrame, long: DataFrame, series: Sequence[str], time: str = "trade_date") -> DataFrame:
    """Last released value of each series on every date of the panel.

    The lookup runs on distinct dates and joins back, so it does not grow with entities.
    """
    dates = panel.select(time).distinct().withColumn("series_id", F.explode(F.array(*[F.lit(s) for s in series])))
    known = asof_join(dates, long.where(F.col("series_id").isin(list(series))), ["series_id"], time, "release_date", ["value", "period"])
    wide = known.groupBy(time).agg(*[F.max(F.when(F.col("series_id") == s, F.col("value"))).alias(s) for s in series])
    return panel.join(wide, time, "left")


# ---------------------------------------------------------------- options
def option_chain(daily: DataFrame, contracts: DataFrame) -> DataFrame:
    """Quotes inside the life of their contract, with the contract's terms."""
    alive = within_life(F.col("trade_date"), F.col("list_date"), F.col("delist_date"))
    return daily.join(contracts, "ts_code").where(alive)


def active_contracts(contracts: DataFrame, calendar: DataFrame, time: str = "trade_date") -> DataFrame:
    """Live contracts per date and side. Listings and delistings are counted per day and
    carried to each calendar date, so no contract is expanded over its life."""
    ok = contracts.where(F.coalesce(F.col("delist_date") >= F.col("list_date"), F.lit(True)))
    changes = (
        ok.select("call_put", F.col("list_date").alias("d"), F.lit(1).alias("delta"))
        .unionByName(ok.where(F.col("delist_date").isNotNull()).select("call_put", F.date_add("delist_date", 1).alias("d"), F.lit(-1).alias("delta")))
        .groupBy("call_put", "d").agg(F.sum("delta").alias("delta"))
    )
    so_far = Window.partitionBy("call_put").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    levels = changes.withColumn("active", F.sum("delta").over(so_far))
    sides = contracts.select("call_put").distinct()
    grid = calendar.select(time).distinct().withColumn("call_put", F.explode(F.array(F.lit("C"), F.lit("P")))).join(sides, "call_put", "left_semi")
    return asof_join(grid, levels, ["call_put"], time, "d", ["active"]).withColumn("active", F.coalesce("active", F.lit(0)))


def moneyness(chain: DataFrame, spot: str, band: float = 0.05) -> DataFrame:
    """ATM / ITM / OTM against the spot column."""
    gap = F.try_divide(F.col(spot) - F.col("exercise_price"), F.col("exercise_price"))
    inside = F.when(F.col("call_put") == "C", gap > 0).otherwise(gap < 0)
    return chain.withColumn("moneyness", F.when(F.abs(gap) <= band, "ATM").when(inside, "ITM").otherwise("OTM"))


def chain_pivot(chain: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    return chain.groupBy(*by).pivot("call_put", ["C", "P"]).agg(F.avg(value))


# ---------------------------------------------------------------- futures
def continuous_price(mapping: DataFrame, daily: DataFrame) -> DataFrame:
    quotes = daily.select(F.col("ts_code").alias("mapping_ts_code"), "trade_date", "close", "vol")
    return mapping.join(quotes, ["mapping_ts_code", "trade_date"], "left")


def mapped_contracts(contracts: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    return contracts.where(starts_with_any("ts_code", prefixes))


# ---------------------------------------------------------------- currencies
def fx_symbols(symbols: DataFrame, classes: Sequence[str], allow: Sequence[str], code: str = "ts_code", kind: str = "classify") -> DataFrame:
    """Symbols of the given classes whose code contains an allowed part."""
    return symbols.where(F.col(kind).isin(list(classes)) & contains_any(code, allow))


def fx_on_calendar(fx: DataFrame, calendar: DataFrame, close_hour_utc: int, pairs: Sequence[str], time: str = "trade_date") -> DataFrame:
    """GMT quotes on the local calendar: a quote after the local close belongs to the next
    day, and every calendar date takes the last quote known by then."""
    local = fx.withColumn("known_on", F.when(F.hour("quote_time_gmt") >= close_hour_utc, F.date_add("trade_date", 1)).otherwise(F.col("trade_date")))
    latest = local.groupBy("ts_code", "known_on").agg(F.max_by(F.struct("bid_close", "ask_close"), "quote_time_gmt").alias("q")).select("ts_code", "known_on", "q.*")
    grid = calendar.select(time).distinct().withColumn("ts_code", F.explode(F.array(*[F.lit(p) for p in pairs])))
    return asof_join(grid, latest, ["ts_code"], time, "known_on", ["bid_close", "ask_close", "known_on"])


def or_configured(selected: DataFrame, configured: DataFrame) -> DataFrame:
    """The selection, or the configured rows when it is empty."""
    nothing = selected.agg((F.count(F.lit(1)) == 0).alias("e")).scalar()
    return selected.unionByName(configured.where(nothing))
