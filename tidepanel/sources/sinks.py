"""Writers. Spark's commit protocol replaces temp-file-and-rename."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.session import cut_lineage
from tidepanel.sources.specs import DatasetSpec


def write_table(df: DataFrame, path: str, codec: str = "snappy", partition_by: Sequence[str] = (), cluster: bool = True) -> None:
    """Overwrite a parquet dataset. Partitioned output is first shuffled by the partition
    columns with AQE free to split large ones, so a partition is a few files, not one per task."""
    if partition_by and cluster:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").option("compression", codec)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], codec: str = "zstd") -> None:
    """Write ``df`` over those partitions of a dataset that it has rows of; files of all others stay as they are.

    ``df`` must not read the dataset any more (``cut_lineage``): the new files replace the old ones on commit.
    """
    clustered = df.hint("rebalance", *partition_by)
    clustered.write.mode("overwrite").option("compression", codec).option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def append_table(df: DataFrame, path: str, codec: str = "zstd") -> bool:
    """Append unless the frame is empty; tells whether rows were written."""
    if df.isEmpty():
        return False
    df.write.mode("append").option("compression", codec).parquet(path)
    return True


def write_by_year(df: DataFrame, path: str, time: str = "trade_date", codec: str = "zstd") -> None:
    """One job for all years: no per-year loop, no merge step."""
    write_table(df.withColumn("year", F.year(time)), path, codec, ["year"])


def write_dataset(df: DataFrame, root: str, spec: DatasetSpec, codec: str = "zstd") -> str:
    """Hive-style layout ``asset/dataset/col=value`` from the dataset's spec."""
    path = f"{root}/{spec.asset_class}/{spec.name}"
    write_table(df, path, codec, [c for c in spec.partition_cols if c in df.columns])
    return path


def write_csv_report(df: DataFrame, path: str, most_rows: int = 1_000_000) -> None:
    """Single CSV file, for metadata-sized tables (registries, profiles); a larger one keeps its files.

    The table is computed in parallel and stored before it goes to one writer.
    """
    stored = cut_lineage(df)
    out = stored.repartition(1) if stored.count() <= most_rows else stored
    out.write.mode("overwrite").option("header", "true").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
