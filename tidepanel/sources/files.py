"""Facts about files that need no full read into a row: checksums by blocks, extents from footers.

Files are opened inside tasks, one file a row, through Arrow's file systems, which know local paths and the usual
remote stores. A store that only Spark can open is left to the caller, who then scans the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = 8 << 20
#: Store schemes that Arrow opens by itself.
KNOWN_SCHEMES = ("file", "hdfs", "s3", "s3a", "gs", "abfs", "abfss")


def opened(path: str) -> pa.NativeFile:
    scheme, _, rest = path.partition(":")
    uri = f"file:///{rest.lstrip('/')}" if scheme == "file" else "s3" + path[3:] if scheme == "s3a" else path
    store, where = pafs.FileSystem.from_uri(uri)
    return store.open_input_file(where)


def listed(spark: SparkSession, root: str, pattern: str = "*.parquet") -> DataFrame:
    """(path, length, modificationTime) of the files under ``root``, at any depth; no content is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length", "modificationTime")


def can_open(files: DataFrame) -> bool:
    """Whether every file's store is one of those that tasks can open."""
    scheme = F.regexp_extract("path", r"^([A-Za-z0-9+.-]+):", 1)
    return files.where(~scheme.isin(*KNOWN_SCHEMES)).isEmpty()


def _spread(files: DataFrame) -> DataFrame:
    """One file a partition as far as there are tasks: large ones must not wait for each other."""
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(parts, "path")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = []
        for path in batch.column("path").to_pylist():
            digest = hashlib.sha256()
            with opened(path) as file:
                while block := file.read(BLOCK):
                    digest.update(block)
            found.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, "sha256"])


def with_checksums(files: DataFrame) -> DataFrame:
    """``files`` (path, ...) with ``sha256``, read block by block: memory does not follow the size of a file."""
    narrow = _spread(files.select("path", F.col("modificationTime").cast("string").alias("modified")))
    return narrow.mapInArrow(_digests, "path string, modified string, sha256 string")


def _footers(column: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, last, sure = [], [], []
            for path in batch.column("path").to_pylist():
                with opened(path) as file:
                    footer = pq.ParquetFile(file).metadata
                at = footer.schema.names.index(column) if column in footer.schema.names else None
                tops, known = [], True
                for g in range(footer.num_row_groups):
                    stats = footer.row_group(g).column(at).statistics if at is not None else None
                    if stats is not None and stats.has_min_max:
                        tops.append(str(stats.max))
                    elif not (stats is not None and stats.has_null_count and stats.null_count == footer.row_group(g).num_rows) and footer.row_group(g).num_rows:
                        known = False  # no statistics: only a scan can tell
                rows.append(footer.num_rows)
                last.append(max(tops, default=None))
                sure.append(known)
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(rows, pa.int64()), pa.array(last, pa.string()), pa.array(sure, pa.bool_())], ["path", "rows", "last", "sure"])

    return run


def footers(files: DataFrame, column: str | None = None) -> DataFrame:
    """(path, rows, last, sure): each Parquet file's row count and largest date in ``column``, from its footer alone."""
    return _spread(files.select("path")).mapInArrow(_footers(column), "path string, rows bigint, last string, sure boolean")


def footer_extent(spark: SparkSession, root: str, time: str) -> DataFrame | None:
    """Row count and last date (compact text) of a Parquet dataset; None if its footers cannot tell."""
    files = listed(spark, root)
    if not can_open(files):
        return None
    found = footers(files, time)
    rows, last, sure, files_read = found.agg(F.sum("rows"), F.max("last"), F.min("sure"), F.count("*")).first()
    if not files_read or not sure:
        return None
    compact = F.regexp_replace(F.substring(F.lit(last), 1, 10), "-", "")
    return spark.range(1).select(F.lit(rows).cast("long").alias("rows"), compact.alias("last_date"))
