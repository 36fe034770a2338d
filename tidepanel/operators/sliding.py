"""Order statistics of a sliding frame: a sorted frame, changed by one insert and one removal a row.

A window function would build the frame's k values again for every row. Here a task streams over its rows in
order and keeps the last k values of the current key twice, by age and sorted, so a row costs a binary
search and a shift of machine words, whatever k is. The rows are the parts of ``slices.halo_rows``: keys of any length are cut
and every part begins with the k - 1 rows before it.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import deque
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.operators.slices import halo_rows, slice_keys
from tidepanel.session import cut_lineage


def _shares(k: int, min_periods: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frame: deque[float | None] = deque()
        ordered: list[float] = []
        for batch in batches:
            first, halo, values = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_first", "_halo", "_x"))
            shares: list[float | None] = []
            for begins, copy, x in zip(first, halo, values, strict=True):
                if begins:
                    frame.clear()
                    ordered.clear()
                frame.append(x)
                if x is not None:
                    insort(ordered, x)
                if len(frame) > k and (old := frame.popleft()) is not None:
                    del ordered[bisect_left(ordered, old)]
                told = not copy and x is not None and len(ordered) >= min_periods
                shares.append(bisect_right(ordered, x) / len(ordered) if told else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shares, pa.float64())], [*batch.schema.names, "_share"])

    return run


def sliding_percentile(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, k: int, out: str, min_periods: int = 1, longest: int | None = None) -> DataFrame:
    """``df`` with the share of the last k rows' present values that are not above the current one.

    NULL where the value is missing (NULL or NaN) or fewer than ``min_periods`` values are present. ``order`` must be
    a total order of a key's rows.
    """
    x = F.col(value).cast("double")
    rows = halo_rows(slice_keys(cut_lineage(df), by, order, longest), by, order, before=k - 1)
    in_part = Window.partitionBy(*by, "_part").orderBy(*order)
    # the window leaves the rows of each part side by side and in order
    ready = rows.withColumns({"_first": F.row_number().over(in_part) == 1, "_x": F.when(~F.isnan(x), x)})
    schema = T.StructType([*ready.schema.fields, T.StructField("_share", T.DoubleType())])
    return ready.mapInArrow(_shares(k, min_periods), schema).where(~F.col("_halo")).select(*df.columns, F.col("_share").alias(out))
