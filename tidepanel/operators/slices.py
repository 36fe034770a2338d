"""Ordered scans over keys of any length.

A window over one key runs in one task. That fits an entity with a bounded history and nothing else, so the scans
here cut the keys that are too long into *slices*, ranges of the scan order with about equally many rows.
A row's slice follows from its own values, so that (key, slice) is an ordinary window partition: one
shuffle, no layout to store, no adaptive help. What a slice needs from those before it travels separately:

* a *last-value* scan needs one row, the newest of the slices before it (``last_value``);
* a row frame needs the k rows before (or after) the slice: its *halo* (``halo_rows``).

A key is long if it has more rows than an average shuffle partition (and than ``LEAST``), so there are fewer long
keys than partitions, whatever the data: that is the bound behind the broadcast of their splitters, of which there are
``PER_PARTITION`` a partition. Splitters are quantiles of a hash sample of ``PER_SLICE`` rows a slice; the sample
moves slice borders and never the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidepanel.session import cut_lineage

#: Slices that a partition's worth of a long key's rows is cut into, and sampled rows a slice.
PER_PARTITION, PER_SLICE = 16, 64
#: Keys of so many rows are never cut.
LEAST = 4096


@dataclass(frozen=True)
class Sliced:
    """``rows`` with ``_slice``; ``long_keys`` (keys, ``_slices``) is None where no key is cut."""

    rows: DataFrame
    long_keys: DataFrame | None


def _place(splits: Column, at: Column, most: int) -> Column:
    """Number of splitters that are not above ``at``: a binary search, one step a bit."""
    bits = [F.lit(1 << b) for b in reversed(range(max(1, most.bit_length())))]
    return F.aggregate(F.array(*bits), F.lit(0), lambda place, step: F.when(F.coalesce(F.try_element_at(splits, place + step) <= at, F.lit(False)), place + step).otherwise(place))


def slice_keys(stored: DataFrame, by: Sequence[str], order: Sequence[str], longest: int | None = None) -> Sliced:
    """Cut the long keys of ``stored``, a table that can be read again, along ``order``, a total order.

    Rows with a NULL key belong to no key; they are spread by the hash of ``order``. ``longest`` is the number
    of rows from which a key is cut (smaller values make more long keys).
    """
    by, parts = list(by), int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = stored.dropna(subset=by)
    counts = known.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    total, most_rows = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    spread = F.pmod(F.xxhash64(*order), F.lit(PER_PARTITION * parts)).cast("int")
    unknown = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in by])
    mean = longest or max((total or 0) // parts, LEAST)
    if (most_rows or 0) <= mean:
        return Sliced(stored.withColumn("_slice", F.when(unknown, spread).otherwise(0)), None)
    # fewer than ``parts`` keys can have more rows than an average partition
    long_keys = F.broadcast(cut_lineage(counts.where(F.col("_rows") > mean)))
    every = max(1, mean // (PER_PARTITION * PER_SLICE))
    at = F.struct(*order)
    sample = known.where(F.pmod(F.xxhash64(*order), F.lit(every)) == 0).join(long_keys, by)
    # at most PER_PARTITION * PER_SLICE values a partition in all
    drawn = sample.groupBy(*by).agg(F.sort_array(F.collect_list(at)).alias("_drawn"), F.ceil(F.max("_rows") * PER_PARTITION / mean).cast("int").alias("_n"))
    cut = F.transform(F.sequence(F.lit(1), F.col("_n") - 1), lambda k: F.get("_drawn", (k * F.size("_drawn") / F.col("_n")).cast("int")))
    splits = cut_lineage(drawn.select(*by, cut.alias("_splits")))
    most = splits.agg(F.max(F.size("_splits"))).first()[0]
    renamed = splits.select(*[F.col(c).alias(f"_s_{c}") for c in by], "_splits")
    same = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_s_{c}") for c in by])
    placed = F.when(unknown, spread).when(F.col("_splits").isNull(), 0).otherwise(_place(F.col("_splits"), at, most))
    rows = stored.join(F.broadcast(renamed), same, "left").withColumn("_slice", placed).select(*stored.columns, "_slice")
    return Sliced(rows, splits.select(*by, (F.size("_splits") + 1).alias("_slices")))


def _grid(sliced: Sliced, by: Sequence[str]) -> DataFrame:
    """All (key, slice) of the long keys."""
    return sliced.long_keys.select(*by, F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)).alias("_slice"))


def _rows_of_long_keys(sliced: Sliced, by: Sequence[str]) -> DataFrame:
    return sliced.rows.join(F.broadcast(sliced.long_keys.select(*by)), list(by), "left_semi")


def last_value(sliced: Sliced, by: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """The rows with the last non-null ``value`` at or before each, in any slice of its key."""
    keys = [*by, "_slice"]
    scan = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    scanned = sliced.rows.withColumn(out, F.last(value, ignorenulls=True).over(scan))
    if sliced.long_keys is None:
        return scanned.drop("_slice")
    newest = _rows_of_long_keys(sliced, by).where(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, F.struct(*order)).alias("_newest"))
    before = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = _grid(sliced, by).join(newest, keys, "left").withColumn("_carried", F.last("_newest", ignorenulls=True).over(before))
    # the scanned side is partitioned by (key, slice) already
    joined = scanned.join(carried.where(F.col("_carried").isNotNull()).select(*keys, "_carried"), keys, "left")
    return joined.withColumn(out, F.coalesce(out, "_carried")).drop("_slice", "_carried")


def halo_rows(sliced: Sliced, by: Sequence[str], order: Sequence[str], before: int = 0, after: int = 0) -> DataFrame:
    """The rows with ``_part`` and ``_halo``: each part also holds copies of the rows around it, marked ``_halo``.

    Parts are runs of slices. Slices whose first row numbers fall into the same k rows, k the wider halo,
    form one part, so the k rows around a part lie in its two neighbours on either side.
    """
    keys, k = [*by, "_part"], max(before, after)
    if sliced.long_keys is None or k == 0:
        return sliced.rows.withColumnRenamed("_slice", "_part").withColumn("_halo", F.lit(False))
    sizes = _grid(sliced, by).join(_rows_of_long_keys(sliced, by).groupBy(*by, "_slice").count(), [*by, "_slice"])
    upto = Window.partitionBy(*by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.withColumn("_begin", F.coalesce(F.sum("count").over(upto), F.lit(0).cast("long")))
    parts = begins.withColumn("_part", F.dense_rank().over(Window.partitionBy(*by).orderBy((F.col("_begin") / k).cast("long"))))
    # one row a slice of a long key: PER_PARTITION a shuffle partition, and one a long key
    parts = F.broadcast(cut_lineage(parts.select(*by, "_slice", "_part")))
    rows = sliced.rows.join(parts, [*by, "_slice"], "left").withColumn("_part", F.coalesce("_part", "_slice")).drop("_slice")
    of_long = rows.join(F.broadcast(sliced.long_keys.select(*by)), list(by), "left_semi")
    out = rows.withColumn("_halo", F.lit(False))
    for width, to, direction in ((before, (1, 2), F.desc), (after, (-1, -2), F.asc)):
        if width:
            place = F.row_number().over(Window.partitionBy(*keys).orderBy(*[direction(c) for c in order]))
            border = of_long.withColumn("_place", place).where(F.col("_place") <= width).drop("_place")
            copies = border.withColumn("_part", F.explode(F.array(*[F.col("_part") + t for t in to])))
            out = out.unionByName(copies.withColumn("_halo", F.lit(True)))
    return out


def over_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[str], columns: Callable[[WindowSpec], dict[str, Column]], before: int = 0, after: int = 0, longest: int | None = None
) -> DataFrame:
    """``df`` with ``columns`` of an ordered window that look at most ``before`` rows back and ``after`` rows on.

    Works for keys of any length; ``order`` must be a total order of a key's rows.
    """
    stored = cut_lineage(df)
    rows = halo_rows(slice_keys(stored, by, order, longest), by, order, before, after)
    window = Window.partitionBy(*by, "_part").orderBy(*order)
    return rows.withColumns(columns(window)).where(~F.col("_halo")).drop("_part", "_halo")
