"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_LOCAL_SCRATCH: dict[str, str] = {}


def build_session(app: str = "tidepanel", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; ``conf`` entries use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a scratch one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _LOCAL_SCRATCH[app]


def shared_path(spark: SparkSession, name: str) -> str:
    """A path for this application in the folder that all executors share."""
    return f"{_shared_folder(spark)}/tidepanel/{spark.sparkContext.applicationId}/{name}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` as a table in the shared checkpoint folder and read it back.

    Used where a later step must see exactly the rows (and partition numbers) of an
    earlier one even if executors are lost in between, and where several steps would
    otherwise recompute the same input. A written table costs one pass, and readers
    fetch only the columns they need. Tables are kept under the application's id; the
    folder's own retention removes them.
    """
    spark = df.sparkSession
    path = shared_path(spark, uuid.uuid4().hex)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def store_bucketed(df: DataFrame, keys: Sequence[str], spread: bool = True) -> DataFrame:
    """Like ``cut_lineage``, as a table bucketed and sorted by ``keys``: joins and groupings on them need no shuffle of it.

    There are as many buckets as shuffle partitions, so tables stored in one session meet bucket by bucket.
    ``spread=False`` saves the shuffle for a frame that is grouped by the keys already.
    """
    spark, name = df.sparkSession, f"tidepanel_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid_out = (df.repartition(buckets, *keys) if spread else df).write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
    laid_out.option("compression", "zstd").option("path", shared_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store it names, asked through Spark's own file systems."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
