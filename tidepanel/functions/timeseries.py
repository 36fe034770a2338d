"""Row-frame time-series expressions over one entity's history.

All of them take the ordered window of the entity. The panel key is (entity,
date), so one entity holds at most one row per calendar date and the window
partition is bounded by the calendar, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from tidepanel.functions.scalars import ColumnLike, as_col, ratio


def entity_window(entity: str = "ts_code", time: str = "trade_date") -> WindowSpec:
    return Window.partitionBy(entity).orderBy(time)


def _trailing(w: WindowSpec, k: int) -> WindowSpec:
    return w.rowsBetween(-(k - 1), 0)


def lag(x: ColumnLike, k: int, w: WindowSpec) -> Column:
    return F.lag(as_col(x), k).over(w)


def roc(x: ColumnLike, k: int, w: WindowSpec) -> Column:
    return ratio(x, lag(x, k, w)) - 1


def diff(x: ColumnLike, k: int, w: WindowSpec) -> Column:
    return as_col(x) - lag(x, k, w)


def forward_return(price: ColumnLike, k: int, w: WindowSpec) -> Column:
    price = as_col(price)
    return ratio(F.lead(price, k).over(w), price) - 1


def rolling_mean(x: ColumnLike, k: int, w: WindowSpec, min_periods: int | None = None) -> Column:
    x, frame = as_col(x), _trailing(w, k)
    return F.when(F.count(x).over(frame) >= (k if min_periods is None else min_periods), F.avg(x).over(frame))


def rolling_std(x: ColumnLike, k: int, w: WindowSpec, min_periods: int | None = None) -> Column:
    x, frame = as_col(x), _trailing(w, k)
    return F.when(F.count(x).over(frame) >= (k if min_periods is None else min_periods), F.stddev_samp(x).over(frame))


def zscore(x: ColumnLike, k: int, w: WindowSpec, min_periods: int | None = None) -> Column:
    """Rolling z-score. ``min_periods`` defaults to the full window; pass ``k // 2`` for the lenient form.

    A constant window has no z-score. Its variance is exactly zero when minimum
    equals maximum, which is tested instead of a rounded standard deviation.
    """
    x, frame = as_col(x), _trailing(w, k)
    spread = F.max(x).over(frame) > F.min(x).over(frame)
    return F.when(spread, ratio(x - rolling_mean(x, k, w, min_periods), rolling_std(x, k, w, min_periods)))


def rolling_percentile(x: ColumnLike, k: int, w: WindowSpec, min_periods: int = 1) -> Column:
    """Share of the last k non-null values that are not above the current one."""
    x = as_col(x)
    history = F.collect_list(x).over(_trailing(w, k))
    below = F.size(F.filter(history, lambda v: v <= x))
    return F.when(x.isNotNull() & (F.size(history) >= min_periods), below / F.size(history))


def forward_fill(x: ColumnLike, w: WindowSpec, limit: int | None = None) -> Column:
    start = Window.unboundedPreceding if limit is None else -limit
    return F.last(as_col(x), ignorenulls=True).over(w.rowsBetween(start, 0))


def backward_fill(x: ColumnLike, w: WindowSpec, limit: int | None = None) -> Column:
    end = Window.unboundedFollowing if limit is None else limit
    return F.first(as_col(x), ignorenulls=True).over(w.rowsBetween(0, end))


def cumulative_sum(x: ColumnLike, w: WindowSpec) -> Column:
    return F.sum(as_col(x)).over(w.rowsBetween(Window.unboundedPreceding, 0))


def cumulative_growth(r: ColumnLike, w: WindowSpec) -> Column:
    """Running product of (1 + r), missing returns skipped.

    A product of signed factors: its sign is the parity of the factors below zero, its size the sum of
    their logarithms, and it stays zero from the first total loss (r = -1) on. NULL before the first return.
    """
    r, frame = as_col(r), w.rowsBetween(Window.unboundedPreceding, 0)
    factor = 1 + r
    turns, size = F.count_if(factor < 0).over(frame), F.sum(F.when(factor != 0, F.ln(F.abs(factor)))).over(frame)
    lost = F.coalesce(F.max(factor == 0).over(frame), F.lit(False))
    return F.when(lost, F.lit(0.0)).otherwise(F.when(turns % 2 == 1, -F.exp(size)).otherwise(F.exp(size)))


# ---------------------------------------------------------------- expression templates
def ts_mean(x: ColumnLike, k: int, w: WindowSpec) -> Column:
    return rolling_mean(x, k, w)


def ts_std(x: ColumnLike, k: int, w: WindowSpec) -> Column:
    return rolling_std(x, k, w)


def ts_rank(x: ColumnLike, k: int, w: WindowSpec) -> Column:
    return rolling_percentile(x, k, w, min_periods=k)


def ts_delta(x: ColumnLike, k: int, w: WindowSpec) -> Column:
    return diff(x, k, w)


def ref(x: ColumnLike, k: int, w: WindowSpec) -> Column:
    return lag(x, k, w)


def div(a: ColumnLike, b: ColumnLike) -> Column:
    return ratio(a, b)


def sub(a: ColumnLike, b: ColumnLike) -> Column:
    return as_col(a) - as_col(b)
