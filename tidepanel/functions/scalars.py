"""Scalar building blocks: division, clipping, flags, dates, hashing.

One null rule holds throughout: missing values are NULL. NaN and Inf never leave
a function, because ANSI mode would abort on the first zero denominator and NaN
sorts above every number.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnLike = Column | str

# Thresholds that decide the published results.
MIN_ABS_DENOMINATOR = 1e-4
EPSILON = 1e-8
OHLC_TOLERANCE = 1e-4
OPEN_END_DATE = "20991231"
DATE_FORMAT = "yyyyMMdd"


def as_col(value: ColumnLike) -> Column:
    return F.col(value) if isinstance(value, str) else value


# ---------------------------------------------------------------- missing values
def no_nan(x: ColumnLike) -> Column:
    x = as_col(x)
    return F.when(~F.isnan(x), x)


def finite(x: ColumnLike) -> Column:
    """NaN and both infinities become NULL."""
    x = as_col(x)
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def lenient_double(x: ColumnLike) -> Column:
    return finite(as_col(x).try_cast("double"))


def fill(x: ColumnLike, value) -> Column:
    return F.coalesce(as_col(x), F.lit(value))


def column_or(df: DataFrame, name: str, default) -> Column:
    return F.col(name) if name in df.columns else F.lit(default)


def any_null(*cols: ColumnLike) -> Column:
    return reduce(or_, [as_col(c).isNull() for c in cols])


def any_nonpositive(*cols: ColumnLike) -> Column:
    return reduce(or_, [F.coalesce(as_col(c) <= 0, F.lit(False)) for c in cols])


def flag(condition: Column) -> Column:
    """Missing comparison counts as false."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def flag_or_null(condition: Column) -> Column:
    """Missing comparison stays missing."""
    return condition.cast("int")


# ---------------------------------------------------------------- arithmetic
def safe_div(n: ColumnLike, d: ColumnLike, min_abs_den: float = MIN_ABS_DENOMINATOR, fill_value=None) -> Column:
    n, d = as_col(n), as_col(d)
    usable = ~F.isnan(d) & (F.abs(d) >= min_abs_den) & (F.abs(d) < F.lit(float("inf")))
    return F.when(usable, F.try_divide(n, d)).otherwise(F.lit(fill_value).cast("double"))


def ratio(n: ColumnLike, d: ColumnLike) -> Column:
    """Plain ratio; a zero denominator gives NULL."""
    return F.try_divide(as_col(n), as_col(d))


def eps_div(n: ColumnLike, d: ColumnLike, eps: float = EPSILON) -> Column:
    return F.try_divide(as_col(n), as_col(d) + F.lit(eps))


def clip(x: ColumnLike, lower=None, upper=None) -> Column:
    """Clip that keeps NULL input NULL and ignores a NULL bound."""
    x = as_col(x)
    bounded = x
    if lower is not None:
        bounded = F.greatest(bounded, lower if isinstance(lower, Column) else F.lit(lower))
    if upper is not None:
        bounded = F.least(bounded, upper if isinstance(upper, Column) else F.lit(upper))
    return F.when(x.isNotNull(), bounded)


def log1p_positive(x: ColumnLike) -> Column:
    x = as_col(x)
    return F.when(x > 0, F.log1p(x))


def log1p_floor0(x: ColumnLike) -> Column:
    return F.log1p(clip(x, lower=0.0))


def row_max(*cols: ColumnLike) -> Column:
    """Row-wise maximum, missing if any input is missing."""
    cols = [as_col(c) for c in cols]
    return F.when(~any_null(*cols), F.greatest(*cols))


def row_min(*cols: ColumnLike) -> Column:
    cols = [as_col(c) for c in cols]
    return F.when(~any_null(*cols), F.least(*cols))


def rescale_units(x: ColumnLike, factor: float = 10.0) -> Column:
    return as_col(x) * F.lit(factor)


def ohlc_valid(o="open", h="high", l="low", c="close", floor: float = 0.01) -> Column:
    """True when the four prices form a possible bar; a missing price is not valid."""
    o, h, l, c = (as_col(v) for v in (o, h, l, c))
    ok = (
        (o > floor) & (h > floor) & (l > floor) & (c > floor)
        & (h >= F.greatest(o, c) - OHLC_TOLERANCE)
        & (l <= F.least(o, c) + OHLC_TOLERANCE)
        & (h >= l)
    )
    return F.coalesce(ok, F.lit(False))


def interval_label(x: ColumnLike, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed intervals with the lowest edge included."""
    x = as_col(x)
    out = F.when((x >= edges[0]) & (x <= edges[1]), labels[0])
    for low, high, label in zip(edges[1:-1], edges[2:], labels[1:]):
        out = out.when((x > low) & (x <= high), label)
    return out


# ---------------------------------------------------------------- dates and periods
def parse_date(x: ColumnLike, fmt: str = DATE_FORMAT) -> Column:
    return F.try_to_date(as_col(x), fmt)


def compact_date(x: ColumnLike) -> Column:
    return F.date_format(as_col(x), DATE_FORMAT)


def iso_to_compact(x: ColumnLike) -> Column:
    return F.date_format(F.try_to_date(as_col(x), "yyyy-MM-dd"), DATE_FORMAT)


def compact_to_iso(x: ColumnLike) -> Column:
    return F.date_format(F.try_to_date(as_col(x), DATE_FORMAT), "yyyy-MM-dd")


def month_of(x: ColumnLike) -> Column:
    return F.date_format(as_col(x), "yyyyMM")


def shift_month(yyyymm: ColumnLike, delta) -> Column:
    first = F.try_to_date(F.concat(as_col(yyyymm), F.lit("01")), DATE_FORMAT)
    return F.date_format(F.add_months(first, delta), "yyyyMM")


def quarter_of(x: ColumnLike) -> Column:
    x = as_col(x)
    return F.concat(F.date_format(x, "yyyy"), F.lit("Q"), F.quarter(x).cast("string"))


def shift_quarter(yyyyq: ColumnLike, delta: int) -> Column:
    q = as_col(yyyyq)
    first = F.try_to_date(
        F.concat(F.substring(q, 1, 4), F.lpad((F.substring(q, 6, 1).cast("int") * 3 - 2).cast("string"), 2, "0"), F.lit("01")),
        DATE_FORMAT,
    )
    return quarter_of(F.add_months(first, 3 * delta))


def report_periods(first: ColumnLike, last: ColumnLike) -> Column:
    """Array of quarter ends between two dates, both included when they are quarter ends."""
    first, last = as_col(first), as_col(last)
    starts = F.sequence(F.trunc(first, "quarter"), F.trunc(last, "quarter"), F.expr("interval 3 months"))
    ends = F.transform(starts, lambda d: F.last_day(F.add_months(d, 2)))
    return F.filter(ends, lambda d: (d >= first) & (d <= last))


# ---------------------------------------------------------------- text and hashing
def starts_with_any(x: ColumnLike, prefixes: Sequence[str]) -> Column:
    """OR of literal prefixes, which the parquet scan can use as a pushed filter."""
    x = as_col(x)
    return reduce(or_, [x.startswith(p) for p in prefixes])


def contains_any(x: ColumnLike, parts: Sequence[str]) -> Column:
    x = as_col(x)
    return reduce(or_, [x.contains(p) for p in parts])


def canonical_json(**fields: ColumnLike) -> Column:
    """JSON text with sorted keys and no blanks."""
    return F.to_json(F.struct(*[as_col(fields[k]).alias(k) for k in sorted(fields)]))


def stable_hash(*cols: ColumnLike) -> Column:
    return F.sha1(F.concat_ws("|", *[as_col(c).cast("string") for c in cols]))


def shard_of(x: ColumnLike, shards: int) -> Column:
    """Shard number from the leading 32 bits of an MD5: the same in every run and engine."""
    head = F.conv(F.substring(F.md5(as_col(x)), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(shards)).cast("int")


def row_fingerprint(df: DataFrame) -> Column:
    return F.xxhash64(*[F.col(c) for c in sorted(df.columns)])


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)
