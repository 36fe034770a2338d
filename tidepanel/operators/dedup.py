"""Deduplication and set operations.

Keep-first / keep-last are aggregations, not ``row_number`` windows: min/max of a
struct combines on the map side, so a key that owns a third of the table reaches
the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    maps = [c for c in rest if isinstance(df.schema[c].dataType, T.MapType)]
    if maps:  # maps have no order: ties go by their sorted entries
        by = F.struct(*order, *[F.array_sort(F.map_entries(c)).alias(c) if c in maps else F.col(c) for c in rest])
        best = (F.max_by if pick is F.max else F.min_by)(F.struct(*order, *rest), by).alias("_best")
    else:
        best = pick(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the largest in ``order``; remaining columns break ties."""
    return _keep(df, keys, order, F.max)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _keep(df, keys, order, F.min)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def duplicate_report(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Total rows, surplus full-row copies and surplus key copies.

    Without ``keys`` the panel key is picked from the columns present.
    """
    if keys is None:
        time = next((c for c in ("trade_time", "trade_date") if c in df.columns), None)
        keys = [c for c in ("ts_code", time) if c in df.columns]
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    per_key = per_row.groupBy(*keys).agg(F.sum("_copies").alias("_rows"), F.sum(F.col("_copies") - 1).alias("_exact"))
    return per_key.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum("_exact"), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicate_keys"),
    )


def union_all(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def promote(fields: Sequence[T.StructType], downcast: bool = False) -> T.StructType:
    """Common schema of drifting parts: first schema fixes the columns, an untyped
    column takes the first concrete type seen, and stays string if there is none."""
    out = []
    for field in fields[0].fields:
        dtype = field.dataType
        if isinstance(dtype, T.NullType):
            typed = [s[field.name].dataType for s in fields[1:] if field.name in s.names]
            dtype = next((d for d in typed if not isinstance(d, T.NullType)), T.StringType())
        if downcast and isinstance(dtype, (T.DoubleType, T.LongType, T.IntegerType)):
            dtype = T.FloatType()
        out.append(T.StructField(field.name, dtype, True))
    return T.StructType(out)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Missing columns become NULL, extra ones are dropped, types are cast leniently."""
    def one(field: T.StructField):
        if field.name not in df.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        source = df.schema[field.name].dataType
        if source == field.dataType:
            return F.col(field.name)
        if isinstance(source, T.NullType):
            return F.lit(None).cast(field.dataType).alias(field.name)
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select(*[one(f) for f in schema.fields])


def union_aligned(frames: Sequence[DataFrame], downcast: bool = False) -> DataFrame:
    schema = promote([f.schema for f in frames], downcast=downcast)
    return union_all(*[align(f, schema) for f in frames])


def set_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def set_union(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).union(right.select(key)).distinct()
