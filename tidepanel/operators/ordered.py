"""Exact order statistics for groups of any size.

A plain window over a group sorts the whole group in one task. That is the right
plan for the market of one date, and the wrong one when a group may hold a third of
the table. The operators here spread one ordered group over many tasks:

1. range-partition on (group, order) so that a large group covers several partitions;
2. write that layout once through ``cut_lineage`` so that partition numbers are fixed;
3. scan locally, and shift each partition by the total of the group's earlier
   partitions. That offset table has at most one row per range partition, which is
   the proven bound behind the broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.session import cut_lineage

#: Sketches that bracket a column's quantiles err by one in ``SKETCH`` of their rows, which are about ``SKETCHED`` in number;
#: a bracket reaches ``MARGIN`` of the ranks to either side, six deviations of such a sample.
SKETCH, SKETCHED, MARGIN = 1000, 250_000, 0.006


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    renamed = right.select(*[F.col(c).alias(f"_k_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for c in keys:
        term = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        cond = term if cond is None else cond & term
    return left.join(renamed, cond, how).drop(*[f"_k_{c}" for c in keys])


def running_total(
    df: DataFrame, by: Sequence[str], order: Sequence[str | Column], weight: str | None = None, out: str = "pos", parts: int | None = None
) -> DataFrame:
    """Exclusive running total of ``weight`` (1 if not given) inside each group.

    ``order`` must be a total order of the group for a reproducible result.
    """
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = list(by)
    w_col = F.col(weight) if weight else F.lit(1)
    laid_out = cut_lineage(
        df.withColumn("_w", w_col.cast("long")).repartitionByRange(parts, *by, *order).withColumn("_part", F.spark_partition_id())
    )
    local = Window.partitionBy("_part", *by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        laid_out.groupBy(*by, "_part").agg(F.sum("_w").alias("_sum"))
        .withColumn("_offset", F.sum("_sum").over(earlier))
        .where("_offset > 0")
        .select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_off_part"), "_offset")
    )
    same = F.col("_part") == F.col("_off_part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    return (
        laid_out.withColumn("_local", F.sum("_w").over(local) - F.col("_w"))
        .join(F.broadcast(offsets), same, "left")
        .withColumn(out, F.col("_local") + F.coalesce("_offset", F.lit(0)))
        .select(*df.columns, out)
    )


def running_levels(df: DataFrame, by: Sequence[str], value: str, weight: str | None = None, parts: int | None = None) -> DataFrame:
    """(by, _v, _n, _from): the distinct values of each group, their weight and the weight below them; NULLs are skipped.

    Rows collapse to (value, weight) before the ordered scan, so repeated values cost nothing. ``weight`` is a
    whole number of copies, one a row if not given.
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v")).agg(F.sum(F.col(weight) if weight else F.lit(1)).cast("long").alias("_n"))
    return running_total(counted.where(F.col("_n") > 0), by, ["_v"], weight="_n", out="_from", parts=parts)


def _with_total(placed: DataFrame, by: Sequence[str]) -> DataFrame:
    sizes = placed.groupBy(*by).agg(F.sum("_n").alias("_total"))  # reads the stored layout, not the input again
    return null_safe_join(placed, sizes, by) if by else placed.withColumn("_total", sizes.select("_total").scalar())


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a ``value`` that is evaluated once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def fused(a: Column, b: Column, c: Column) -> Column:
    """a * b + c rounded once: products of halves and two-sums carry what each step rounds off."""
    def half(x: Column) -> Column:
        return x * 134217729.0 - (x * 134217729.0 - x)  # the upper 26 bits

    def two_sum(x: Column, y: Column, **more: Column) -> Column:
        return _let(F.struct(x.alias("x"), y.alias("y"), (x + y).alias("s")), lambda v: F.struct(
            v.s.alias("s"), ((v.x - (v.s - (v.s - v.x))) + (v.y - (v.s - v.x))).alias("r"), *[m.alias(n) for n, m in more.items()]))

    def product(v: Column) -> Column:
        low_a, low_b, p = v.a - v.ah, v.b - v.bh, v.a * v.b
        return F.struct(p.alias("p"), (((v.ah * v.bh - p) + v.ah * low_b + low_a * v.bh) + low_a * low_b).alias("e"))

    def nearest(v: Column) -> Column:
        # a tie of the last sum goes where the rest points
        tie = (F.signum(v.rest) == F.signum(v.r)) & (v.r != 0) & ((v.s + 2 * v.r) - v.s == 2 * v.r)
        return F.when(tie, v.s + 2 * v.r).otherwise(v.s)

    exact = _let(F.struct(a.alias("a"), b.alias("b"), half(a).alias("ah"), half(b).alias("bh")), product)
    return _let(exact, lambda v: _let(two_sum(v.p, c), lambda s: _let(two_sum(s.r, v.e), lambda t: _let(two_sum(s.s, t.s, rest=t.r), nearest))))


def stepped(lo: Column, hi: Column, at: Column) -> Column:
    """What lies at place ``at`` between its neighbours, to the last bit as SQL's ``quantile_cont`` evaluates it, so that
    cuts between neighbouring doubles fall alike: lo * (1 - d) + (hi * d), the outer product and the sum rounded once.

    Only edges that rounding could bring onto a neighbour, or past it, need that; the others are told by any form.
    """
    lo, hi, d = lo.cast("double"), hi.cast("double"), at - F.floor(at)
    near = F.least(d, 1 - d) * (hi - lo) <= 1e-12 * F.greatest(F.abs(lo), F.abs(hi))
    return F.when(d == 0, lo).when(near, fused(lo, 1 - d, hi * d)).otherwise(lo * (1 - d) + hi * d)


def quantile_parts(probs: dict[str, float], interpolation: str) -> tuple[dict[str, Column], list[Column]]:
    """The aggregates of a group's ``_v, _n, _from, _total`` that its quantiles need, by name, and the quantiles made of them."""
    def value_at(k: Column) -> Column:
        return F.max(F.when((F.col("_from") <= k) & (k < F.col("_from") + F.col("_n")), F.col("_v")))

    aggs, out = {}, []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_total") - 1)
        if interpolation == "nearest":
            aggs[name] = value_at(F.floor(at + 0.5))
            out.append(F.col(name))
        else:
            aggs |= {f"_lo_{name}": value_at(F.floor(at)), f"_hi_{name}": value_at(F.ceil(at)), f"_at_{name}": F.max(at)}
            lo, hi, place = F.col(f"_lo_{name}"), F.col(f"_hi_{name}"), F.col(f"_at_{name}")
            if interpolation == "stepped":
                out.append(stepped(lo, hi, place).alias(name))
                continue
            # the form that percentile() evaluates, so that both plans give the same bits
            between = (F.ceil(place) - place) * lo + (place - F.floor(place)) * hi
            out.append(F.when(lo == hi, lo.cast("double")).otherwise(between).alias(name))
    return aggs, out


def quantiles_of(levels: DataFrame, by: Sequence[str], probs: dict[str, float], interpolation: str = "linear", total: str | None = None) -> DataFrame:
    """Exact quantiles of ``running_levels``, one column per entry of ``probs``; ``total`` names a column for the group's weight.

    A value of weight n counts as n equal rows. ``interpolation`` is "linear" (evaluated as ``percentile()`` does),
    "stepped" (linear, evaluated by ``stepped``) or "nearest" (half rounds away from zero).
    """
    aggs, out = quantile_parts(probs, interpolation)
    if total:
        aggs[total] = F.max("_total")
    placed = _with_total(levels, by).groupBy(*by).agg(*[a.alias(name) for name, a in aggs.items()])
    return placed.select(*by, *out, *([total] if total else []))


def exact_quantiles(
    df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float], interpolation: str = "linear", parts: int | None = None, weight: str | None = None
) -> DataFrame:
    """Exact, optionally weighted quantiles per group; see ``quantiles_of``."""
    by = list(by)
    return quantiles_of(running_levels(df, by, value, weight, parts), by, probs, interpolation)


def _brackets(edges: Sequence[float]) -> np.ndarray:
    """(low, high) pairs as one ascending list of disjoint closed intervals."""
    out: list[float] = []
    for low, high in sorted(zip(edges[::2], edges[1::2], strict=True)):
        if out and low <= out[-1]:
            out[-1] = max(out[-1], high)
        else:
            out += [low, high]
    return np.array(out)


def _count_slots(edges: dict[str, np.ndarray]):
    """Rows ``(name, _slot, _v, _n)``: every value inside a bracket (odd slots), and between two brackets (even slots) their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for c, cuts in edges.items():
                x = batch.column(c).drop_null().to_numpy(zero_copy_only=False)
                slot = np.searchsorted(cuts[::2], x, "right") + np.searchsorted(cuts[1::2], x, "left")
                inside = slot % 2 == 1
                values, n = np.unique(x[inside] + 0.0, return_counts=True)  # no negative zeros
                between = np.bincount(slot[~inside], minlength=1)
                held = np.flatnonzero(between)
                places = np.searchsorted(cuts[::2], values, "right") + np.searchsorted(cuts[1::2], values, "left")
                parts.append((c, np.concatenate([held, places]), [None] * len(held), values, np.concatenate([between[held], n])))
            names = pa.array([c for c, at, *_ in parts for _ in range(len(at))], pa.string())
            values = pa.concat_arrays([pa.array(v, pa.float64()) for _, _, gaps, inside, _ in parts for v in (gaps, inside)]) if parts else pa.array([], pa.float64())
            joined = [pa.array(np.concatenate([p[i] for p in parts] or [np.zeros(0)]).astype(kind)) for i, kind in ((1, np.int32), (4, np.int64))]
            yield pa.RecordBatch.from_arrays([names, joined[0], values, joined[1]], ["_name", "_slot", "_v", "_n"])

    return run


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: dict[str, float], interpolation: str = "linear", name: str = "_var") -> DataFrame:
    """(name, one column per entry of ``probs``): exact quantiles of whole columns of ``df``, a table that can be read again.

    Sketches of a sample first bracket every quantile by two values. Then values inside a bracket are counted one by one,
    and all between two brackets as one, batch by batch in Arrow tasks: a few hundredths of the values are shuffled and ordered. The
    sketches choose the brackets and never the result: a quantile outside its bracket is sought among all values. NaN is the largest value.
    """
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    around = [min(1.0, max(0.0, p + side * MARGIN)) for p in probs.values() for side in (-1, 1)]
    rows = df.count()
    sample = numbers.sample(SKETCHED / rows, seed=42) if rows > SKETCHED else numbers
    found = sample.agg(*[F.percentile_approx(F.nanvl(c, F.lit(math.inf)), F.array(*map(F.lit, around)), F.lit(SKETCH)).alias(c) for c in cols]).first()
    # the sample's ends are not the column's
    ends = {0.0: -math.inf, 1.0: math.inf}
    edges = {c: _brackets([ends.get(p, e) for p, e in zip(around, found[c] or around, strict=True)]) for c in cols}
    counted = numbers.mapInArrow(_count_slots(edges), "_name string, _slot int, _v double, _n bigint").withColumnRenamed("_name", name)
    counted = counted.groupBy(name, "_slot", "_v").agg(F.sum("_n").alias("_n"))
    out = cut_lineage(quantiles_of(running_total(counted, [name], ["_slot", "_v"], weight="_n", out="_from"), [name], probs, interpolation))
    missed = [r[0] for r in out.where(" or ".join(f"`{q}` is null" for q in probs)).select(name).collect()]
    if not missed:
        return out
    again = numbers.unpivot([], missed, name, "_x").where(F.col("_x").isNotNull())
    return out.where(~F.col(name).isin(missed)).unionByName(exact_quantiles(again.select(name, "_x"), [name], "_x", probs, interpolation))


def group_width(df: DataFrame, by: Sequence[str]) -> int:
    """Rows in the largest group: a keys-only aggregation used to choose a plan."""
    row = df.groupBy(*by).count().agg(F.max("count")).first()
    return int(row[0] or 0)


def group_size(df: DataFrame, by: Sequence[str], out: str) -> DataFrame:
    """``df``, a table that can be read again, with the number of rows of each row's group; keys must not be NULL.

    A group larger than an average shuffle partition gets its size by broadcast (there are fewer
    of them than partitions), the others by a join on the key.
    """
    by = list(by)
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias(out))
    mean = df.count() // int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = F.broadcast(cut_lineage(sizes.where(F.col(out) > mean)))
    rest = df.join(large.select(*by), by, "left_anti").join(sizes.where(F.col(out) <= mean), by)
    return df.join(large, by).select(*df.columns, out).unionByName(rest.select(*df.columns, out))
