"""Increment planning, ledger, lineage and compaction as table jobs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.functions.scalars import canonical_json, compact_date, quarter_of, shift_month, shift_quarter
from tidepanel.operators.dedup import keep_first, keep_last, union_aligned
from tidepanel.operators.ordered import running_total
from tidepanel.session import cut_lineage, path_exists
from tidepanel.sources import files
from tidepanel.sources.sinks import replace_partitions
from tidepanel.sources.specs import DatasetSpec, SpecError

# Default look-back of period datasets.
LOOKBACK_MONTHS, LOOKBACK_QUARTERS = 24, 8


def task_key(dataset: Column, params: Column) -> Column:
    return F.sha1(F.concat_ws("|", dataset, params))


def _with_keys(tasks: DataFrame) -> DataFrame:
    return tasks.withColumns({"task_key": task_key(F.col("dataset"), F.col("params")), "params_hash": F.sha1("params")})


def trade_date_tasks(calendar: DataFrame, specs: Sequence[DatasetSpec], time: str = "trade_date") -> DataFrame:
    """One task per (dataset, trading date)."""
    if any(s.date_col is None for s in specs):
        raise SpecError("trade_date tasks need a date column")
    names = F.explode(F.array(*[F.struct(F.lit(s.name).alias("dataset"), F.lit(s.date_col).alias("col")) for s in specs]))
    rows = calendar.select(time).distinct().select(compact_date(time).alias("d"), names.alias("s")).select("d", "s.*")
    return _with_keys(rows.select("dataset", F.to_json(F.create_map("col", "d")).alias("params")))


def code_year_tasks(codes: DataFrame, spec: DatasetSpec, start: str, end: str) -> DataFrame:
    """One task per (code, calendar year), clipped to the requested range."""
    s, e = F.to_date(F.lit(start), "yyyyMMdd"), F.to_date(F.lit(end), "yyyyMMdd")
    years = codes.select("ts_code").distinct().select("ts_code", F.explode(F.sequence(F.year(s), F.year(e))).alias("y"))
    lo, hi = F.greatest(s, F.make_date("y", F.lit(1), F.lit(1))), F.least(e, F.make_date("y", F.lit(12), F.lit(31)))
    params = canonical_json(ts_code="ts_code", start_date=compact_date(lo), end_date=compact_date(hi))
    return _with_keys(years.select(F.lit(spec.name).alias("dataset"), params.alias("params")))


def snapshot_tasks(spark: SparkSession, spec: DatasetSpec, params: dict[str, str] | None = None) -> DataFrame:
    body = canonical_json(**{k: F.lit(v) for k, v in params.items()}) if params else F.lit("{}")
    return _with_keys(spark.range(1).select(F.lit(spec.name).alias("dataset"), body.alias("params")))


def period_tasks(spark: SparkSession, spec: DatasetSpec, start: str, end: str) -> DataFrame:
    unit = {"period_month": "m", "period_quarter": "q"}.get(spec.fetch_mode)
    if unit is None:
        raise SpecError(f"{spec.name}: not a period dataset")
    return snapshot_tasks(spark, spec, {f"start_{unit}": start, f"end_{unit}": end})


def lookback(last: Column) -> dict[str, Column]:
    """Default start and end periods for a last date."""
    month = F.date_format(last, "yyyyMM")
    quarter = quarter_of(last)
    return {"start_m": shift_month(month, -LOOKBACK_MONTHS), "end_m": month, "start_q": shift_quarter(quarter, -LOOKBACK_QUARTERS), "end_q": quarter}


def pending(planned: DataFrame, done: DataFrame, key: str = "task_key") -> DataFrame:
    return planned.join(done.select(key).distinct(), key, "left_anti")


def ledger_state(ledger: DataFrame, sequence: str | None = None) -> DataFrame:
    """Current state of an append-only ledger: the last written row per task.

    ``sequence`` numbers the writes and decides between rows of one ``updated_at``.
    """
    return keep_last(ledger, ["task_key"], ["updated_at", *([sequence] if sequence else [])])


def resume_dates(history: DataFrame, entity: str, time: str) -> DataFrame:
    """Inclusive restart date per entity, as compact text."""
    return history.groupBy(entity).agg(F.max(time).alias("_t")).select(entity, compact_date("_t").alias("resume_date"))


def resume_date(history: DataFrame, time: str) -> str:
    last = history.agg(F.max(time)).first()[0]
    if last is None:
        raise ValueError("no history to resume from")
    return str(last).replace("-", "")[:8]


def compact(frames: Sequence[DataFrame], order: Sequence[str], downcast: bool = False) -> DataFrame:
    """Schema-aligned union of parts, first row kept per (code, time)."""
    merged = union_aligned(frames, downcast=downcast)
    time = "trade_time" if "trade_time" in merged.columns else "trade_date"
    return keep_first(merged, ["ts_code", time], order)


def compact_into(path: str, parts: DataFrame, partition_by: Sequence[str], keys: Sequence[str], order: Sequence[str], codec: str = "zstd") -> list[tuple]:
    """Merge new rows into a partitioned dataset, touching only the partitions that they fall into.

    Of the rows of one key, new and stored, the last in ``order`` stays; a stored row comes before a new one of equal
    ``order``. Only touched partitions are read and written; the files of the others keep their
    names. Returns the touched partitions. A dataset that does not exist yet is created.
    """
    spark = parts.sparkSession
    fresh = cut_lineage(parts.withColumn("_new", F.lit(1)))
    # partition values: as many as the calendar has periods, not as the data has rows
    touched = [tuple(r) for r in fresh.select(*partition_by).distinct().collect()]
    if not touched:
        return []
    merged = fresh
    if path_exists(spark, path):
        stored = spark.read.parquet(path)
        hit = reduce(lambda a, b: a | b, [reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v).cast(stored.schema[c].dataType)) for c, v in zip(partition_by, values, strict=True)]) for values in touched])
        kinds = [F.col(c).cast(fresh.schema[c].dataType).alias(c) if c in partition_by else F.col(c) for c in stored.columns]
        merged = union_aligned([stored.where(hit).select(*kinds).withColumn("_new", F.lit(0)), fresh])
    kept = keep_last(merged, list(keys), [*order, "_new"]).drop("_new")
    replace_partitions(cut_lineage(kept), path, partition_by, codec)
    return touched


def month_batches(codes: DataFrame, calendar: DataFrame, size: int, time: str = "trade_date") -> DataFrame:
    """Batches of codes already listed in each traded month.

    ``codes``: (ts_code, list_date as compact text). Codes per month are numbered with
    split running totals, since every code appears in every later month. Months expand
    from each code's listing month, so there is no month x code range join.
    """
    months = calendar.select(F.trunc(time, "month").alias("m")).distinct()
    span = months.agg(F.struct(F.min("m").alias("lo"), F.max("m").alias("hi")).alias("s")).scalar()
    listed = F.coalesce(F.trunc(F.try_to_date("list_date", "yyyyMMdd"), "month"), F.col("s")["lo"])
    start = F.greatest(listed, F.col("s")["lo"])
    rows = codes.select("ts_code", "list_date", span.alias("s")).where(start <= F.col("s")["hi"]).select(
        "ts_code", F.explode(F.sequence(start, F.col("s")["hi"], F.expr("interval 1 month"))).alias("m")
    )
    rows = rows.join(months, "m", "left_semi").select(F.date_format("m", "yyyyMM").alias("month"), "ts_code")
    numbered = running_total(rows, ["month"], ["ts_code"], out="pos")
    return numbered.select("month", "ts_code", F.floor(F.col("pos") / size).cast("long").alias("batch"))


def batch_keys(batches: DataFrame) -> DataFrame:
    return batches.groupBy("month", "batch").agg(F.count(F.lit(1)).alias("codes")).withColumn("task_key", F.concat("month", F.lit("_b"), F.lpad(F.col("batch").cast("string"), 5, "0")))


def lineage(spark: SparkSession, path: str, dataset: str, api_name: str, version: str) -> DataFrame:
    """One record per parquet file: rows, columns, SHA-256, time and version.

    Files are hashed block by block and their rows come from the footers, one file a row of the listing, so a
    file may have any size. In a store that only Spark opens, contents are read as rows (up to 2 GB a file).
    """
    found = files.listed(spark, path)
    columns = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path).columns
    if files.can_open(found):
        digest = files.with_checksums(found).join(files.footers(found).select("path", "rows"), "path", "left")
        digest = digest.select("path", "rows", "sha256", F.to_timestamp("modified").alias("fetched_at"))
    else:
        whole = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
        table = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(path)
        rows = table.select(F.col("_metadata.file_path").alias("path")).groupBy("path").agg(F.count(F.lit(1)).alias("rows"))
        same_name = F.regexp_replace("path", "^file:/+", "/")
        digest = whole.select(same_name.alias("path"), F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("fetched_at"))
        digest = digest.join(rows.withColumn("path", same_name), "path", "left")
    return digest.select(
        F.lit(dataset).alias("dataset"), F.lit(api_name).alias("api_name"), F.regexp_replace("path", "^file:/+", "/").alias("path"), F.coalesce("rows", F.lit(0)).alias("rows"),
        F.array(*[F.lit(c) for c in columns]).alias("columns"), F.concat(F.lit("sha256:"), F.col("sha256")).alias("checksum"), "fetched_at", F.lit(version).alias("code_version"),
    )
