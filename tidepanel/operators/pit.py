"""Point-in-time joins: as-of, validity intervals and trailing calendar sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.operators.cross_section import choose_plan
from tidepanel.operators.ordered import group_size, quantile_parts, quantiles_of, running_total
from tidepanel.operators.slices import last_value, slice_keys
from tidepanel.session import cut_lineage

def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_on: str,
    right_on: str,
    payload: Sequence[str],
    right_order: Sequence[str] = (),
    longest: int | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Latest right row with ``right_on <= left_on`` per key; unmatched left rows keep NULLs.

    A NULL key matches nothing. Of right rows at one time, the last in ``right_order`` counts.

    Both sides are stacked, stored once and scanned once in the order (time, side, tie), whatever
    the length of a key (``slices.last_value``; ``longest`` rows of a key are scanned in one piece). The right row travels as one struct, so a NULL field of the
    matched row is never replaced by an older row's value. Select the wanted columns of ``left`` first: all are stored.

    ``bounded`` is the caller's word that no key has more rows than a calendar has dates, as in a panel (one row per key
    and date on either side): then a plain window scans the keys, with one shuffle and nothing stored or counted.
    """
    by = list(by)
    kept = [c for c in left.columns if c not in by]
    left_rows = left.select(*by, F.col(left_on).alias("_t"), F.lit(1).alias("_side"), *[F.col(c).alias(f"_l_{c}") for c in kept])
    right_rows = right.dropna(subset=[*by, right_on]).select(
        *by, F.col(right_on).alias("_t"), F.lit(0).alias("_side"), F.struct(F.lit(0), *right_order).alias("_tie"), F.struct(*payload).alias("_right")
    )
    stacked = left_rows.unionByName(right_rows, allowMissingColumns=True)
    order = ["_t", "_side", "_tie"]
    if bounded:
        scan = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        scanned = stacked.withColumn("_match", F.last("_right", ignorenulls=True).over(scan)).where("_side = 1")
    else:
        stacked, order = cut_lineage(stacked.withColumn("_id", F.monotonically_increasing_id())), [*order, "_id"]
        scanned = last_value(slice_keys(stacked, by, order, longest), by, order, "_right", "_match").where("_side = 1")
    # rows with a NULL key share slices, but right rows never have one
    return scanned.select(*by, *[F.col(f"_l_{c}").alias(c) for c in kept], *[F.col("_match")[c].alias(c) for c in payload])


def share_at_or_below(points: DataFrame, levels: DataFrame, by: Sequence[str], at: str, out: str) -> DataFrame:
    """``points`` with the share of its group's weight at values up to ``at``; NULL where the group has no value.

    ``levels`` are the group's ``running_levels``: a point looks up the last value that is not above it, whose
    running count is the answer, so no point meets a group's values.
    """
    counted = levels.select(*by, F.col("_v"), (F.col("_from") + F.col("_n")).alias("_upto"))
    totals = levels.groupBy(*by).agg(F.sum("_n").alias("_total"))
    found = asof_join(points, counted, by, at, "_v", ["_upto"]).join(totals, list(by), "left")
    share = F.when(F.col(at).isNotNull(), F.coalesce("_upto", F.lit(0)) / F.col("_total"))
    return found.select(*points.columns, share.alias(out))


def shares_and_quantiles(
    points: DataFrame, df: DataFrame, by: Sequence[str], value: str, at: str, out: str, probs: dict[str, float], plan: str = "auto", width: int | None = None
) -> DataFrame:
    """``points`` with the share of their group's values in ``df`` up to ``at``, and the group's exact quantiles ``probs`` of ``value``.

    All are NULL where the group has no value, and the share where ``at`` is NULL. Points stand in the ordered scan
    of the values, without weight and behind equal values, so their running total is the answer and no point looks up
    a value. The window plan scans a group in one task, with one shuffle and nothing stored; the split plan lays values
    and points out over all tasks. ``width`` bounds the rows of a group, otherwise those of ``df`` are counted.
    """
    by = list(by)
    rest = [c for c in points.columns if c not in by]
    known = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_v"))
    asking = points.select(*by, F.col(at).alias("_v"), F.lit(0).cast("long").alias("_n"), F.xxhash64(*rest).alias("_tie"), F.struct(*rest).alias("_point"))
    share = F.when(F.col(at).isNotNull(), F.col("_from") / F.col("_total")).alias(out)
    if choose_plan(known, by, plan, width) == "window":
        group = Window.partitionBy(*by)
        stacked = known.withColumn("_n", F.lit(1).cast("long")).unionByName(asking.drop("_tie").withColumn("_side", F.lit(1)), allowMissingColumns=True)
        upto = group.orderBy("_v", F.col("_side").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
        scanned = stacked.withColumns({"_from": F.sum("_n").over(upto) - F.col("_n"), "_total": F.nullif(F.sum("_n").over(group), F.lit(0))})
        aggs, results = quantile_parts(probs, "linear")
        found = scanned.withColumns({f"_q{i}": a.over(group) for i, a in enumerate(aggs.values())}).where("_side = 1")
        found = found.select(*by, "_point.*", "_from", "_total", *[F.col(f"_q{i}").alias(name) for i, name in enumerate(aggs)])
        return found.select(*points.columns, *results, share)
    counted = known.groupBy(*by, "_v").agg(F.count(F.lit(1)).alias("_n"))
    placed = running_total(counted.unionByName(asking, allowMissingColumns=True), by, ["_v", "_tie"], weight="_n", out="_from")
    levels = placed.where("_tie is null").select(*by, "_v", "_n", "_from")
    found = placed.where("_tie is not null").select(*by, "_point.*", "_from").join(quantiles_of(levels, by, probs, total="_total"), by, "left")
    return found.select(*points.columns, *probs, share)


def interval_asof(
    facts: DataFrame, intervals: DataFrame, by: str, at: str, start: str, end: str, payload: Sequence[str], how: str = "inner", bounded: bool = False
) -> DataFrame:
    """Latest interval that has started, kept only while ``at < end``; of one start, the latest end.

    ``how="inner"`` drops rows without a valid interval, ``how="left"`` blanks them. ``bounded`` as in ``asof_join``.
    """
    wanted = [*dict.fromkeys([*payload, start, end])]
    joined = asof_join(facts, intervals, [by], at, start, wanted, right_order=[*dict.fromkeys([end, *payload])], bounded=bounded)
    valid = F.col(at) < F.col(end)
    if how == "inner":
        return joined.where(valid)
    return joined.withColumns({c: F.when(valid, F.col(c)) for c in wanted})


def disjoint_segments(intervals: DataFrame, by: str, start: str, end: str, payload: Sequence[str]) -> DataFrame:
    """(by, _from, _win): from ``_from`` on, until the next row of the key, the interval ``_win`` wins; NULL in a gap.

    Intervals are half open. Of those that hold a point, the latest start wins, then the latest end, then the payload.
    The points are the intervals' ends, numbered per key. Every interval is cut into at most two blocks a level
    of the dyadic blocks of these numbers, and the winner of each block is an aggregate; a point asks the blocks
    above it, one a level. No task sees a key's intervals, and n of them make O(n log n) rows.
    """
    known = intervals.where(F.col(by).isNotNull() & (F.col(start) < F.col(end)))
    one = known.groupBy(by, F.col(start).alias("_s"), F.col(end).alias("_e")).agg(F.max(F.struct(*payload)).alias("_p"))
    points = one.select(by, F.explode(F.array("_s", "_e")).alias("_from")).distinct()
    points = cut_lineage(group_size(running_total(points, [by], ["_from"], out="_n"), [by], "_size"))
    number = lambda at, out: points.select(by, F.col("_from").alias(at), F.col("_n").alias(out))
    placed = one.join(number("_s", "_lo"), [by, "_s"]).join(number("_e", "_hi"), [by, "_e"])
    one_level = lambda n, k: F.floor(n / F.pow(F.lit(2), k)).cast("long")

    def blocks(k: Column) -> Column:
        lo, hi = -one_level(-F.col("_lo"), k), one_level(F.col("_hi"), k)
        odd = lambda n: F.pmod(n, F.lit(2)) == 1
        return F.array(F.when((lo < hi) & odd(lo), F.struct(k.alias("_level"), lo.alias("_block"))), F.when((lo < hi) & odd(hi), F.struct(k.alias("_level"), (hi - 1).alias("_block"))))

    levels = F.sequence(F.lit(0), F.ceil(F.log2(F.col("_hi") - F.col("_lo"))).cast("int") + 1)
    cut = placed.select(by, F.explode(F.array_compact(F.flatten(F.transform(levels, blocks)))).alias("_b"), F.struct("_s", "_e", "_p").alias("_win"))
    best = cut.groupBy(by, "_b._level", "_b._block").agg(F.max("_win").alias("_win"))
    above = F.transform(F.sequence(F.lit(0), F.ceil(F.log2("_size")).cast("int")), lambda k: F.struct(k.alias("_level"), one_level(F.col("_n"), k).alias("_block")))
    asked = points.select(by, "_from", F.explode(above).alias("_b")).select(by, "_from", "_b._level", "_b._block")
    return asked.join(best, [by, "_level", "_block"], "left").groupBy(by, "_from").agg(F.max("_win").alias("_win"))


def interval_range(
    facts: DataFrame, intervals: DataFrame, by: str, at: str, start: str, end: str, payload: Sequence[str]
) -> DataFrame:
    """``start <= at < end``; with overlaps the latest start wins; unmatched rows are kept.

    Overlapping intervals are cut into disjoint segments with one winner each, and every fact looks up the
    last segment that has begun: it never meets the other intervals of its key.
    """
    segments = disjoint_segments(intervals, by, start, end, payload)
    found = asof_join(facts, segments, [by], at, "_from", ["_win"])
    return found.select(*facts.columns, *[F.col("_win._p")[c].alias(c) for c in payload])


def with_ordinal(calendar: DataFrame, time: str = "trade_date") -> DataFrame:
    """0-based position of every date. The calendar is the list of distinct dates
    (thousands of rows by nature), so one window task over it is safe."""
    return calendar.select(time).distinct().withColumn("ord", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(time)) - 1)


def trailing_dates(anchors: DataFrame, calendar: DataFrame, n: int, anchor: str = "rebal_date", time: str = "trade_date") -> DataFrame:
    """(anchor, date) pairs for the n calendar dates before each anchor, anchor excluded.

    Ordinals are expanded and looked up by equality, so there is no range join.
    """
    ords = with_ordinal(calendar, time)
    spans = (
        anchors.select(F.col(anchor)).distinct()
        .join(ords, F.col(anchor) == F.col(time))
        .where(F.col("ord") > 0)
        .select(anchor, F.explode(F.sequence(F.greatest(F.col("ord") - n, F.lit(0)), F.col("ord") - 1)).alias("ord"))
    )
    return spans.join(ords, "ord").select(anchor, time)


def within_life(at: Column, start: Column, end: Column) -> Column:
    return (at >= start) & (F.coalesce(at <= end, F.lit(True)))
