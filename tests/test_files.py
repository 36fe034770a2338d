"""Checksums by blocks and extents from footers, against a read of the whole files."""

import hashlib
import pathlib

from pyspark.sql import functions as F

from suite import QUERIES
from tidepanel.sources import files, readers


def test_lineage_of_given_tables(spark, sf_dir):
    rows = {r["path"]: r for r in QUERIES["table_lineage"](spark, sf_dir).collect()}
    assert set(rows) == {"orders.parquet", "lineitem.parquet", "documents.parquet"}
    for name, r in rows.items():
        path = pathlib.Path(sf_dir, name)
        assert r["checksum"] == "sha256:" + hashlib.sha256(path.read_bytes()).hexdigest()
        assert r["rows"] == spark.read.parquet(str(path)).count() and r["columns"] == spark.read.parquet(str(path)).columns


def test_a_file_of_many_blocks(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(bytes(range(256)) * 90_000)  # 23 MB: three blocks
    (tmp_path / "b.bin").write_bytes(b"b")
    found = {pathlib.Path(r.path).name: r.sha256 for r in files.with_checksums(files.listed(spark, str(tmp_path), "*.bin")).collect()}
    assert found == {p.name: hashlib.sha256(p.read_bytes()).hexdigest() for p in tmp_path.glob("*.bin")}


def test_extent_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("d"))
    df.withColumns({"t": F.col("d").cast("timestamp"), "s": F.date_format("d", "yyyyMMdd"), "none": F.lit(None).cast("date")}).repartition(3).write.parquet(path)
    for column in ("d", "t", "s"):
        (got,) = readers.dataset_extent(spark, path, column).collect()
        assert (got.rows, got.last_date) == (1000, "20240330") == tuple(readers.table_extent(spark.read.parquet(path), column).first())
        assert column == "t" or files.footer_extent(spark, path, column) is not None  # 96-bit timestamps have no statistics
    assert tuple(files.footer_extent(spark, path, "none").first()) == (1000, None)
    df.write.partitionBy("d").parquet(f"{path}-parts")
    assert files.footer_extent(spark, f"{path}-parts", "d") is None  # the column is in the folders' names only
    assert readers.dataset_extent(spark, f"{path}-parts", "d").first().last_date == "20240330"
    df.where("k > 99").write.parquet(f"{path}-none")
    assert tuple(readers.dataset_extent(spark, f"{path}-none", "d").first()) == (0, None)
