"""Coverage, contracts and rule checks on raw and derived tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.sources.specs import DatasetSpec


def coverage_gaps(expected: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """Every key that is on one side only, tagged ``missing`` or ``extra``."""
    e, g = expected.select(key).distinct(), got.select(key).distinct()
    return e.join(g, key, "left_anti").withColumn("kind", F.lit("missing")).unionByName(g.join(e, key, "left_anti").withColumn("kind", F.lit("extra")))


def coverage_report(expected: DataFrame, got: DataFrame, key: str) -> DataFrame:
    """Counts of expected, present, missing and extra keys; ``coverage_gaps`` lists the keys themselves."""
    tagged = (
        expected.select(key).distinct().withColumn("_e", F.lit(1))
        .join(got.select(key).distinct().withColumn("_g", F.lit(1)), key, "full")
    )
    return tagged.agg(
        F.count("_e").alias("expected"), F.count("_g").alias("present"),
        F.count_if(F.col("_g").isNull()).alias("missing"), F.count_if(F.col("_e").isNull()).alias("extra"),
        F.min(F.when(F.col("_g").isNull(), F.col(key))).alias("first_missing"), F.max(F.when(F.col("_g").isNull(), F.col(key))).alias("last_missing"),
    )


def contract_violations(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Violation counts of a dataset against its spec: absent columns, null keys, surplus keys."""
    absent = [c for c in spec.required_columns if c not in df.columns]
    keys = [c for c in spec.pk_cols if c in df.columns]
    head = [F.lit(spec.name).alias("dataset"), F.lit(",".join(absent)).alias("absent_columns"), "rows", "null_keys", "surplus_keys"]
    if not keys:  # without any key column neither count is defined
        return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(None).cast("long").alias("null_keys"), F.lit(None).cast("long").alias("surplus_keys")).select(*head)
    null_key = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("rows"), F.sum(F.when(null_key, F.col("n")).otherwise(0)).alias("null_keys"), F.sum(F.col("n") - 1).alias("surplus_keys")).select(*head)


def column_contract(spark: SparkSession, required: Sequence[str], available: Sequence[str], max_distance: int = 3) -> DataFrame:
    """Required names, whether present, and present names within an edit distance."""
    names = F.array(*[F.lit(a) for a in sorted(available)])
    rows = spark.createDataFrame([(r,) for r in required], "name string")
    near = F.filter(names, lambda a: (F.levenshtein(a, F.col("name")) <= max_distance) & (a != F.col("name")))
    return rows.select("name", F.array_contains(names, F.col("name")).alias("present"), near.alias("near_matches"))


def distinct_extent(df: DataFrame, entity: str = "ts_code", time: str = "trade_date") -> DataFrame:
    return df.agg(F.count_distinct(entity).alias("entities"), F.count_distinct(time).alias("dates"), F.count(F.lit(1)).alias("rows"))


def compaction_check(df: DataFrame, time: str) -> DataFrame:
    """Rows, date range and the columns that hold no value at all."""
    empty = F.concat_ws(",", *[F.when(F.count(c) == 0, F.lit(c)) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("rows"), F.min(time).alias("first_date"), F.max(time).alias("last_date"), empty.alias("empty_columns"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).unpivot([], list(columns), "column", "nulls")


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per named rule; a missing condition is not a violation."""
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()]).unpivot([], list(rules), "rule", "violations")


# ---------------------------------------------------------------- asset-specific checks
def option_lifecycle(daily: DataFrame, contracts: DataFrame) -> DataFrame:
    """Quotes outside the contract's life, negative interest or volume, surplus keys."""
    j = daily.join(contracts.select("ts_code", "list_date", "delist_date"), "ts_code")
    d = F.col("trade_date")
    rules = rule_counts(
        j, {"before_listing": d < F.col("list_date"), "after_delisting": d > F.col("delist_date"), "negative_oi": F.col("oi") < 0, "negative_vol": F.col("vol") < 0}
    )
    keys = daily.groupBy("ts_code", "trade_date").count().agg(F.sum(F.col("count") - 1).alias("violations"))
    return rules.unionByName(keys.select(F.lit("surplus_key").alias("rule"), "violations"))


def strike_gaps(contracts: DataFrame) -> DataFrame:
    """Largest step between neighbouring strikes of an underlying and side. Strikes are
    deduplicated first, so the ordered set is the strike ladder, not the contract list."""
    ladder = contracts.select("underlying", "call_put", "exercise_price").distinct()
    w = Window.partitionBy("underlying", "call_put").orderBy("exercise_price")
    step = F.col("exercise_price") - F.lag("exercise_price").over(w)
    return ladder.withColumn("step", step).groupBy("underlying", "call_put").agg(F.count(F.lit(1)).alias("strikes"), F.max("step").alias("max_step"), F.min("step").alias("min_step"))


def ambiguous_mappings(mapping: DataFrame) -> DataFrame:
    """Continuous codes with more than one month contract on a date."""
    return mapping.groupBy("cont_code", "trade_date").agg(F.count_distinct("mapping_ts_code").alias("contracts")).where("contracts > 1")


def period_end(period: Column) -> Column:
    """Last day of a month ``yyyyMM`` or a quarter ``yyyyQn``; NULL for anything else."""
    month = F.when(period.rlike(r"^\d{6}$"), F.last_day(F.try_to_date(period, "yyyyMM")))
    first = F.make_date(F.substring(period, 1, 4).cast("int"), F.substring(period, 6, 1).cast("int") * 3, F.lit(1))
    return F.when(period.rlike(r"^\d{4}Q[1-4]$"), F.last_day(first)).otherwise(month)


def macro_checks(long: DataFrame, today: str, recent: str) -> DataFrame:
    """Surplus series keys, malformed periods, future periods, missing recent values.

    ``today`` and ``recent`` are months; periods of any frequency compare by their last day.
    """
    month, quarter = F.col("period").rlike(r"^\d{4}(0[1-9]|1[0-2])$"), F.col("period").rlike(r"^\d{4}Q[1-4]$")
    well_formed = F.when(F.col("frequency") == "M", month).otherwise(quarter)
    rules = rule_counts(
        long, {"bad_period": ~well_formed, "future_period": period_end(F.col("period")) > period_end(F.lit(today)), "recent_null": (period_end(F.col("period")) >= period_end(F.lit(recent))) & F.col("value").isNull()}
    )
    keys = long.groupBy("series_id", "value_type", "period").count().agg(F.sum(F.col("count") - 1).alias("violations"))
    return rules.unionByName(keys.select(F.lit("surplus_key").alias("rule"), "violations"))


def fx_checks(daily: DataFrame) -> DataFrame:
    rules = rule_counts(daily, {"ask_below_bid": F.col("ask_close") < F.col("bid_close"), "negative_ticks": F.col("tick_qty") < 0, "no_gmt_stamp": F.col("quote_time_gmt").isNull()})
    keys = daily.groupBy("ts_code", "trade_date").count().agg(F.sum(F.col("count") - 1).alias("violations"))
    return rules.unionByName(keys.select(F.lit("surplus_key").alias("rule"), "violations"))


def fingerprint(df: DataFrame, keys: Sequence[str], time: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, unique keys, last date, column count and an order-free hash of the listed columns (all by default).

    A row's fields are joined so that no two rows share a text (JSON, with doubles as their bits);
    the four 60-bit parts of its SHA-256 are summed, so equal rows count each time.
    """
    def field(c: str) -> Column:
        dtype = dict(df.dtypes)[c]
        x = F.xxhash64(F.lit(0), F.col(c).cast("double")) if dtype in ("double", "float") else F.col(c)
        return F.when(F.col(c).isNotNull(), x.cast("string"))

    columns = list(columns or df.columns)
    digest = F.sha2(F.to_json(F.array(*[field(c) for c in columns])), 256)
    parts = [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)").alias(f"_h{i}") for i in range(4)]
    # keys are counted by aggregation first: the global step sees one row per task
    per_key = df.withColumns({f"_h{i}": p for i, p in enumerate(parts)}).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.max(time).alias("_t"), *[F.sum(f"_h{i}").cast("decimal(38,0)").alias(f"_h{i}") for i in range(4)]
    )
    return per_key.agg(
        F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("unique_keys"), F.max("_t").alias("last_date"),
        F.concat_ws("-", *[F.sum(f"_h{i}").cast("string") for i in range(4)]).alias("content_hash"),
    ).withColumn("columns", F.lit(len(columns)))
