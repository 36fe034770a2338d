"""Factor evaluation: information coefficients, quantile returns, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions import timeseries as ts
from tidepanel.functions.scalars import ratio
from tidepanel.operators.cross_section import add_bucket, add_ranks

PERIODS_PER_YEAR = 252


def correlation(x: str, y: str) -> Column:
    """Pearson correlation; NULL when either side is constant."""
    varies = (F.max(x) > F.min(x)) & (F.max(y) > F.min(y))
    return F.when(varies, ratio(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)))


def forward_returns(df: DataFrame, price: str = "close", horizons: Sequence[int] = (1, 5, 20)) -> DataFrame:
    w = ts.entity_window()
    return df.withColumns({f"ret_{k}": ts.forward_return(price, k, w) for k in horizons})


def long_returns(df: DataFrame, keep: Sequence[str], returns: Sequence[str]) -> DataFrame:
    """One row per (row, horizon): every horizon is evaluated in the same jobs."""
    return df.select(*keep, *returns).unpivot(list(keep), list(returns), "horizon", "ret")


def information_coefficients(df: DataFrame, factor: str, by: Sequence[str], ret: str = "ret", plan: str = "auto", width: int | None = None) -> DataFrame:
    """IC and rank IC per group, on rows where factor and return are present."""
    both = df.where(F.col(factor).isNotNull() & F.col(ret).isNotNull())
    ranked = add_ranks(both, {"_fr": factor, "_rr": ret}, by, ["ts_code"], "ts_code", method="average", plan=plan, width=width)
    return ranked.groupBy(*by).agg(correlation(factor, ret).alias("ic"), correlation("_fr", "_rr").alias("rank_ic"), F.count(F.lit(1)).alias("n_obs"))


def ic_summary(ics: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean, sample deviation and their ratio (0 for a zero deviation) plus the positive share."""
    def block(c: str) -> list[Column]:
        mean, std = F.avg(c), F.stddev_samp(c)
        return [
            mean.alias(f"{c}_mean"), std.alias(f"{c}_std"),
            F.when(std == 0, 0.0).otherwise(ratio(mean, std)).alias(f"{c}_ir"),
            # a coefficient that is zero up to rounding noise is not positive
            F.avg((F.round(c, 9) > 0).cast("int")).alias(f"{c}_positive_share"),
        ]

    return ics.groupBy(*by).agg(*block("ic"), *block("rank_ic"), F.count(F.lit(1)).alias("n_dates"), F.sum("n_obs").alias("n_obs"))


def quantile_returns(df: DataFrame, factor: str, by: Sequence[str], groups: int = 5, ret: str = "ret", plan: str = "auto", width: int | None = None) -> DataFrame:
    """Mean return of each factor quantile (group_0 lowest) and top minus bottom."""
    cut = add_bucket(df, factor, by, groups, "_bucket", plan=plan, width=width).where(F.col("_bucket").isNotNull())
    wide = cut.groupBy(*by).agg(*[F.avg(F.when(F.col("_bucket") == g + 1, F.col(ret))).alias(f"group_{g}") for g in range(groups)])
    return wide.withColumn("long_short", F.col(f"group_{groups - 1}") - F.col("group_0"))


def evaluate(df: DataFrame, factor: str, returns: Sequence[str] = ("ret_1", "ret_5", "ret_20"), groups: int = 5, plan: str = "auto", width: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(per-date series, per-horizon summary) for all horizons at once."""
    rows = long_returns(df, ["ts_code", "trade_date", factor], returns)
    by = ["horizon", "trade_date"]
    ics = information_coefficients(rows, factor, by, plan=plan, width=width)
    series = ics.join(quantile_returns(rows, factor, by, groups, plan=plan, width=width), by, "full")
    return series, ic_summary(ics, ["horizon"])


def series_window(by: Sequence[str]):
    """Ordered dates of one evaluated series; bounded by the calendar."""
    return Window.partitionBy(*by).orderBy("trade_date")


def cumulative_series(series: DataFrame, by: Sequence[str], sums: Sequence[str], growths: Sequence[str], rolling: dict[str, int]) -> DataFrame:
    w = series_window(by)
    return series.withColumns(
        {
            **{f"{c}_ma{k}": ts.rolling_mean(c, k, w) for c, k in rolling.items()},
            **{f"{c}_cumsum": ts.cumulative_sum(c, w) for c in sums},
            **{f"{c}_nav": ts.cumulative_growth(c, w) for c in growths},
        }
    )


def performance(series: DataFrame, ret: str, by: Sequence[str], periods: int = PERIODS_PER_YEAR) -> DataFrame:
    """Annual return, volatility, Sharpe ratio and maximum drawdown of a return series."""
    w = series_window(by)
    nav = series.where(F.col(ret).isNotNull()).withColumn("_nav", ts.cumulative_growth(ret, w))
    peak = F.greatest(F.max("_nav").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(1.0))
    nav = nav.withColumn("_dd", ratio(F.col("_nav"), peak) - 1)
    mean, std = F.avg(ret), F.stddev_samp(ret)
    return nav.groupBy(*by).agg(
        (mean * periods).alias("annual_return"), (std * F.sqrt(F.lit(float(periods)))).alias("annual_volatility"),
        (ratio(mean, std) * F.sqrt(F.lit(float(periods)))).alias("sharpe"), F.min("_dd").alias("max_drawdown"), F.count(F.lit(1)).alias("n_periods"),
    )


def top_group_turnover(df: DataFrame, factor: str, groups: int = 5, plan: str = "auto", width: int | None = None) -> DataFrame:
    """Per date: share of the top group that was not in it on the entity's previous row; and coverage."""
    cut = add_bucket(df, factor, ["trade_date"], groups, "_b", plan=plan, width=width)
    top = F.coalesce(F.col("_b") == groups, F.lit(False))
    cut = cut.withColumn("_top", top).withColumn("_was", F.coalesce(F.lag("_top").over(ts.entity_window()), F.lit(False)))
    return cut.groupBy("trade_date").agg(
        ratio(F.count_if(F.col("_top") & ~F.col("_was")), F.count_if("_top")).alias("turnover"),
        (F.count(factor) / F.count(F.lit(1))).alias("coverage"),
        F.count(F.lit(1)).alias("n_rows"),
    )


def capacity(df: DataFrame, factor: str, size: str, activity: str, groups: int = 10, plan: str = "auto", width: int | None = None) -> DataFrame:
    """Mean size and activity of the top group per date."""
    cut = add_bucket(df, factor, ["trade_date"], groups, "_b", plan=plan, width=width)
    return cut.where(F.col("_b") == groups).groupBy("trade_date").agg(F.avg(size).alias("top_size"), F.avg(activity).alias("top_activity"), F.count(F.lit(1)).alias("n_top"))


def tradable(df: DataFrame, stocks: DataFrame, suspended: DataFrame, limits: DataFrame, min_days: int = 60) -> DataFrame:
    """Rows of entities listed long enough, not under special treatment (name), not suspended that day and not closed at a price limit."""
    if "name" in stocks.columns:
        stocks = stocks.where(~F.coalesce(F.col("name").rlike(r"^\*?ST"), F.lit(False)))
    listed = stocks.select("ts_code", F.try_to_date("list_date", "yyyyMMdd").alias("_listed")).dropna()
    out = df.join(listed, "ts_code").where(F.datediff("trade_date", "_listed") >= min_days).drop("_listed")
    out = out.join(suspended.select("ts_code", "trade_date").distinct(), ["ts_code", "trade_date"], "left_anti")
    out = out.join(limits.select("ts_code", "trade_date", "up_limit", "down_limit"), ["ts_code", "trade_date"], "left")
    at_limit = (F.col("close") >= F.col("up_limit")) | (F.col("close") <= F.col("down_limit"))
    return out.where(~F.coalesce(at_limit, F.lit(False))).drop("up_limit", "down_limit")
