"""Streaming form of the intraday summary and of bar deduplication.

An extension over the batch jobs, which remain the definition of the results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.scalars import flag_or_null, safe_div

LATENESS = "1 day"


def stream_bars(raw: DataFrame) -> DataFrame:
    """First copy of every (code, bar time) within the watermark, with derived columns."""
    bars = raw.withWatermark("trade_time", LATENESS).dropDuplicatesWithinWatermark(["ts_code", "trade_time"])
    return bars.withColumns(
        {"hour": F.hour("trade_time"), "vol": F.abs("vol"), "amount": F.abs("amount"), "ret_h": F.when(F.abs("open") >= 0.05, F.try_divide(F.col("close"), F.col("open")) - 1)}
    )


def daily_summary(bars: DataFrame) -> DataFrame:
    """Aggregates per (code, day window); a day is emitted once the watermark passes it."""
    t = F.col("trade_time")
    day = bars.groupBy("ts_code", F.window("trade_time", "1 day").alias("w")).agg(
        F.min_by("open", t).alias("open_day"), F.max_by("close", t).alias("close_day"), F.max("high").alias("high_day"), F.min("low").alias("low_day"),
        F.coalesce(F.sum("vol"), F.lit(0.0)).alias("vol_total"), F.coalesce(F.sum("amount"), F.lit(0.0)).alias("amount_total"),
        F.coalesce(F.sum(F.abs("ret_h")), F.lit(0.0)).alias("sum_abs_ret"), F.count(F.lit(1)).alias("count"),
        F.coalesce(F.sum(F.when(F.col("hour") >= 13, F.col("vol"))), F.lit(0.0)).alias("vol_pm"),
    )
    valid = (F.col("low_day") > 0) & (F.col("open_day") > 0) & (F.col("close_day") > 0) & (F.col("high_day") > 0) & (F.col("count") >= 2)
    return day.withColumns(
        {
            "trade_date": F.to_date("w.start"),
            "low_bar_count_flag": flag_or_null(F.col("count") < 2),
            "intraday_trend_eff": F.when(valid, safe_div(F.col("close_day") - F.col("open_day"), "sum_abs_ret", 1e-5)),
            "volume_concentration_pm": F.when(valid, safe_div("vol_pm", "vol_total", 1.0)),
        }
    ).drop("w")
