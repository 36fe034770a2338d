"""Readers: projected parquet, globs, snapshots, CSV, table extents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.functions.scalars import OPEN_END_DATE
from tidepanel.sources.files import footer_extent, listed


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, where: Column | None = None) -> DataFrame:
    """Parquet scan; the column list and filter reach the scan. Globs are allowed.

    A missing path raises ``AnalysisException``.
    """
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def read_parts(spark: SparkSession, root: str, pattern: str = "*.parquet", merge_schema: bool = False) -> DataFrame:
    """Every part file under ``root``, at any depth."""
    return (
        spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("mergeSchema", str(merge_schema).lower()).parquet(root)
    )


def part_files(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """Path, size and modification time of every part file; contents are not read."""
    return listed(spark, root, pattern)


def latest_snapshot(df: DataFrame, column: str = "snapshot_date") -> DataFrame:
    """Rows of the newest snapshot; on a partition column the scan prunes to it."""
    newest = df.agg(F.max(column).alias("d"))
    return df.where(F.col(column) == newest.scalar())


def industry_members(df: DataFrame) -> DataFrame:
    return df.withColumn("out_date", F.coalesce("out_date", F.lit(OPEN_END_DATE)))


def listed_codes(stocks: DataFrame) -> DataFrame:
    """Distinct codes with their listing date."""
    return stocks.select("ts_code", "list_date").dropna(subset=["ts_code"]).distinct()


def table_extent(df: DataFrame, time: str) -> DataFrame:
    """Row count and last date (compact text), by a scan of one column; see ``dataset_extent``."""
    last = F.max(F.col(time).cast("date").cast("string")) if dict(df.dtypes)[time] in ("timestamp", "timestamp_ntz", "date") else F.max(F.col(time).cast("string"))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.regexp_replace(last, "-", "").alias("last_date"))


def dataset_extent(spark: SparkSession, path: str, time: str) -> DataFrame:
    """Row count and last date of a Parquet dataset from its files' footers, one small read a file.

    Where the footers cannot tell (no statistics, or a store that only Spark opens) one column is scanned.
    """
    found = footer_extent(spark, path, time)
    return found if found is not None else table_extent(spark.read.parquet(path), time)


def read_profile_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)
