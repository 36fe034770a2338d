"""Result shaping shared by all registered queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def rounded(df: DataFrame, digits: int = 6, exact: Sequence[str] = ()) -> DataFrame:
    """Doubles rounded (unless listed in ``exact``), negative zero removed, dates as compact text, integers widened.

    A double is scaled, rounded half away from zero and scaled back, as SQL engines do: 41 / 640 lies in the middle
    of two results only as a decimal, not as a double.
    """
    half, scale = 0.5 * 10 ** -digits, float(10 ** digits)
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.name in exact:
            pass
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.abs(c) < half, F.lit(0.0)).otherwise(F.round(c * scale, 0) / scale).alias(f.name)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyyMMdd").alias(f.name)
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.LongType)):
            c = c.cast("long").alias(f.name)
        out.append(c)
    return df.select(*out)
