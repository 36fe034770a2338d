"""Stratified entity pools: half-year rebalances, quotas by industry and size bucket.

All rebalance dates are processed together: the date is part of every key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.scalars import interval_label, parse_date
from tidepanel.operators.cross_section import add_ranks
from tidepanel.operators.ordered import running_total
from tidepanel.operators.pit import trailing_dates
from tidepanel.session import cut_lineage

# The published selection rules.
REBALANCE_MONTHS = (1, 7)
MIN_LISTED_DAYS = 252
COVERAGE_DATES, COVERAGE_SHARE = 120, 0.95
LIQUIDITY_DATES = 60
BUCKET_EDGES, BUCKET_LABELS = (0.0, 0.35, 0.80, 1.0), ("small", "mid", "big")
INDUSTRY_BASE, INDUSTRY_CAP = 2, 12
SEED = 42


def static_pool(index_daily: DataFrame, n: int) -> DataFrame:
    """The n largest entities by market value on the latest date."""
    latest = index_daily.agg(F.max("trade_date").alias("d"))
    return index_daily.where(F.col("trade_date") == latest.select("d").scalar()).orderBy(F.desc("circ_mv"), "ts_code").limit(n).select("ts_code", "trade_date", "circ_mv")


def rebalance_dates(calendar: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """First trading date of every January and July."""
    d = F.col("trade_date")
    return (
        calendar.where(F.month(d).isin(*REBALANCE_MONTHS) & F.year(d).between(first_year, last_year))
        .groupBy(F.year(d).alias("_y"), F.month(d).alias("_m")).agg(F.min(d).alias("rebal_date")).select("rebal_date")
    )


def eligible(index_daily: DataFrame, rebal: DataFrame) -> DataFrame:
    """Entities on a rebalance date with label, size and listing date, not ST, listed long enough."""
    label = F.coalesce("industry", "l1_name")
    rows = index_daily.join(rebal, F.col("trade_date") == F.col("rebal_date")).withColumns(
        {"industry_label": label, "list_dt": parse_date("list_date")}
    )
    rows = rows.dropna(subset=["industry_label", "circ_mv", "list_dt"])
    rows = rows.where(~F.coalesce(F.col("name").contains("ST"), F.lit(False)))
    return rows.where(F.datediff("rebal_date", "list_dt") >= MIN_LISTED_DAYS).select("rebal_date", "ts_code", "industry_label", "circ_mv")


def covered(rows: DataFrame, features: DataFrame, rebal: DataFrame, calendar: DataFrame, share: float = COVERAGE_SHARE) -> DataFrame:
    """Keep entities with feature rows on enough of the preceding dates."""
    spans = trailing_dates(rebal, calendar, COVERAGE_DATES)
    needed = spans.groupBy("rebal_date").agg((F.count(F.lit(1)) * share).alias("_need"))
    counts = features.select("ts_code", "trade_date").join(spans, "trade_date").groupBy("rebal_date", "ts_code").agg(F.count(F.lit(1)).alias("_have"))
    good = counts.join(needed, "rebal_date").where(F.col("_have") >= F.col("_need"))
    no_history = rebal.join(needed, "rebal_date", "left_anti")
    return rows.join(good.select("rebal_date", "ts_code"), ["rebal_date", "ts_code"], "left_semi").unionByName(rows.join(no_history, "rebal_date", "left_semi"))


def with_liquidity(rows: DataFrame, daily: DataFrame, rebal: DataFrame, calendar: DataFrame) -> DataFrame:
    """Score = mean amount over the preceding dates; only positive scores stay."""
    spans = trailing_dates(rebal, calendar, LIQUIDITY_DATES)
    mean = daily.select("ts_code", "trade_date", "amount").join(spans, "trade_date").groupBy("rebal_date", "ts_code").agg(F.avg("amount").alias("score"))
    scored = rows.join(mean, ["rebal_date", "ts_code"]).where(F.col("score") > 0)
    no_history = rebal.join(spans.select("rebal_date").distinct(), "rebal_date", "left_anti")
    return scored.unionByName(rows.join(no_history, "rebal_date", "left_semi").withColumn("score", F.lit(0.0)))


def with_size_bucket(rows: DataFrame, plan: str = "auto", width: int | None = None) -> DataFrame:
    ranked = add_ranks(rows, {"mv_rank": "circ_mv"}, ["rebal_date"], ["ts_code"], "ts_code", method="average", plan=plan, width=width)
    return ranked.withColumn("bucket", interval_label("mv_rank", BUCKET_EDGES, BUCKET_LABELS))


def industry_quotas(rows: DataFrame, target: int) -> DataFrame:
    """Seats per (rebalance, industry): base plus a share of the rest by square root of size, half to even."""
    w = Window.partitionBy("rebal_date")
    q = rows.groupBy("rebal_date", "industry_label").agg(F.count(F.lit(1)).alias("n"))
    rest = F.lit(target) - F.lit(INDUSTRY_BASE) * F.count(F.lit(1)).over(w)
    proportional = F.bround(F.col("n") / F.sum("n").over(w) * target)
    rooted = INDUSTRY_BASE + F.bround(F.sqrt("n") / F.sum(F.sqrt("n")).over(w) * rest)
    q = q.withColumn("seats", F.when(rest < 0, proportional).otherwise(rooted).cast("long"))
    q = q.withColumn("seats", F.least("seats", F.lit(INDUSTRY_CAP), "n"))
    gap = F.lit(target) - F.sum("seats").over(w)
    q = q.withColumns({"gap": gap, "size_order": F.row_number().over(w.orderBy(F.desc("n"), "industry_label"))})
    moved = F.when(F.col("size_order") <= F.abs("gap"), F.signum("gap").cast("long")).otherwise(F.lit(0))
    return q.select("rebal_date", "industry_label", "n", (F.col("seats") + moved).alias("seats"))


def bucket_quotas(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """Seats per size bucket inside an industry; the rounding gap goes to the most frequent bucket."""
    keys = ["rebal_date", "industry_label"]
    w = Window.partitionBy(*keys)
    counts = rows.groupBy(*keys, "bucket").agg(F.count(F.lit(1)).alias("k"))
    b = counts.join(quotas.where("seats > 0").select(*keys, "seats"), keys)
    b = b.withColumn("b_seats", F.bround(F.col("k") / F.sum("k").over(w) * F.col("seats")).cast("long"))
    b = b.withColumns({"left_over": F.col("seats") - F.sum("b_seats").over(w), "order": F.row_number().over(w.orderBy(F.desc("k"), "bucket"))})
    return b.select(*keys, "bucket", "k", (F.col("b_seats") + F.when(F.col("order") == 1, F.col("left_over")).otherwise(F.lit(0))).alias("b_seats"))


def seeded_order(date: str = "rebal_date", entity: str = "ts_code") -> Column:
    """Reproducible pseudo-random order: a hash of entity and the rebalance seed."""
    seed = F.lit(SEED) + F.year(date) + F.month(date)
    return F.md5(F.concat_ws("|", F.col(entity), seed.cast("string")))


def draw(rows: DataFrame, quotas: DataFrame, plan: str = "window") -> DataFrame:
    """Top 2n of each stratum by score, then n of them in seeded order.

    ``plan="split"`` numbers rows with range-partitioned running totals, for strata too
    large to sort in one task.
    """
    keys = ["rebal_date", "industry_label", "bucket"]
    pool = rows.join(quotas.where("b_seats > 0").select(*keys, "b_seats"), keys)
    if plan == "split":
        best = running_total(pool, keys, [F.desc("score"), F.col("ts_code")], out="_pos").where("_pos < 2 * b_seats").drop("_pos")
        best = best.withColumn("_lot", seeded_order())
        return running_total(best, keys, ["_lot", "ts_code"], out="_pos").where("_pos < b_seats").drop("_pos", "_lot", "b_seats")
    w = Window.partitionBy(*keys)
    best = pool.withColumn("_pos", F.row_number().over(w.orderBy(F.desc("score"), "ts_code"))).where("_pos <= 2 * b_seats")
    return best.withColumn("_pos", F.row_number().over(w.orderBy(seeded_order(), "ts_code"))).where("_pos <= b_seats").drop("_pos", "b_seats")


def candidates(index_daily: DataFrame, daily: DataFrame, features: DataFrame, calendar: DataFrame, first_year: int, last_year: int, plan: str = "auto", width: int | None = None, coverage_share: float = COVERAGE_SHARE) -> DataFrame:
    """All steps up to the size bucket. The dates and the result are stored once: the
    dates feed five joins, the candidates feed quotas and draw."""
    rebal = cut_lineage(rebalance_dates(calendar, first_year, last_year))
    rows = covered(eligible(index_daily, rebal), features, rebal, calendar, coverage_share)
    return cut_lineage(with_size_bucket(with_liquidity(rows, daily, rebal, calendar), plan, width))


def build_pool(rows: DataFrame, target: int, plan: str = "window") -> DataFrame:
    return draw(rows, bucket_quotas(rows, industry_quotas(rows, target)), plan)


def pool_map(pool: DataFrame) -> DataFrame:
    """One row per rebalance date with its sorted codes; a pool has about ``target`` members."""
    return pool.groupBy("rebal_date").agg(F.sort_array(F.collect_list("ts_code")).alias("codes"))


def pool_distribution(pool: DataFrame, by: str) -> DataFrame:
    return pool.groupBy("rebal_date", by).agg(F.count(F.lit(1)).alias("members"))
