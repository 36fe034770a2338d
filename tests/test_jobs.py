"""Specs, increments, lineage, sinks, profiles and the streaming extension."""

import dataclasses
import hashlib
import json
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidepanel.operators import increments, profile, quality
from tidepanel.plans import domains
from tidepanel.session import cut_lineage
from tidepanel.sources import readers, sinks
from tidepanel.sources.specs import SPECS, DatasetSpec, SpecError
from tidepanel.sources.star_views import StarViews
from tidepanel.streaming import intraday_stream

GOOD = DatasetSpec("x", "x", "stock", "trade_date", ("ts_code",), ("trade_date",), "trade_date")


def test_good_spec_passes():
    GOOD.validate()


@pytest.mark.parametrize("change", [
    {"name": " "}, {"api_name": ""}, {"pk_cols": ()}, {"limit": 0}, {"date_col": " "}, {"pk_cols": ("a", "a")},
    {"partition_cols": ("a", "a")}, {"required_fields": ("a",), "optional_fields": ("a",)},
])
def test_bad_specs_raise(change):
    with pytest.raises(SpecError):
        dataclasses.replace(GOOD, **change).validate()


def test_catalog_specs_are_valid_and_declare_their_keys():
    assert len(SPECS) == 24
    for spec in SPECS.values():
        spec.validate()
        assert set(spec.pk_cols) <= set(spec.required_fields)


def test_task_keys_follow_canonical_json(spark):
    spec = SPECS["cffex_fut_daily"]
    task = increments.code_year_tasks(spark.createDataFrame([("IF",)], "ts_code string"), spec, "20231201", "20240105").orderBy("params").collect()
    assert [json.loads(t.params) for t in task] == [
        {"ts_code": "IF", "start_date": "20231201", "end_date": "20231231"}, {"ts_code": "IF", "start_date": "20240101", "end_date": "20240105"}]
    for t in task:
        text = json.dumps(json.loads(t.params), sort_keys=True, separators=(",", ":"))
        assert t.task_key == hashlib.sha1(f"{spec.name}|{text}".encode()).hexdigest()
        assert t.params_hash == hashlib.sha1(text.encode()).hexdigest()


def test_snapshot_and_period_tasks(spark):
    assert increments.snapshot_tasks(spark, SPECS["fx_basic"]).first().params == "{}"
    assert json.loads(increments.period_tasks(spark, SPECS["macro_gdp"], "2022Q1", "2024Q1").first().params) == {"start_q": "2022Q1", "end_q": "2024Q1"}
    with pytest.raises(SpecError):
        increments.period_tasks(spark, SPECS["fx_basic"], "a", "b")


def test_two_row_dataset_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("000300.SH", "20240102", 1.0), ("000300.SH", "20240103", 2.0)], "ts_code string, trade_date string, close double")
    path = sinks.write_dataset(df, str(tmp_path), SPECS["stock_daily"])
    back = readers.read_table(spark, path, ["ts_code", "close"], F.col("trade_date") == 20240103)
    assert [tuple(r) for r in back.collect()] == [("000300.SH", 2.0)]
    records = increments.lineage(spark, path, "stock_daily", "daily", "v1").collect()
    files = sorted(pathlib.Path(path).rglob("*.parquet"))
    assert sum(r.rows for r in records) == 2 and len(records) == len(files)
    digests = {"sha256:" + hashlib.sha256(f.read_bytes()).hexdigest() for f in files}
    assert {r.checksum for r in records} == digests
    assert readers.part_files(spark, path).count() == len(files) and readers.read_parts(spark, path).count() == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "2023-05-01", 1.0), ("b", "2024-05-01", 2.0)], "ts_code string, d string, x double").withColumn("trade_date", F.to_date("d"))
    sinks.write_by_year(df, f"{tmp_path}/y")
    assert sorted(p.name for p in pathlib.Path(f"{tmp_path}/y").glob("year=*")) == ["year=2023", "year=2024"]
    assert not sinks.append_table(df.where("x > 9"), f"{tmp_path}/a") and sinks.append_table(df, f"{tmp_path}/a") and sinks.append_table(df, f"{tmp_path}/a")
    assert spark.read.parquet(f"{tmp_path}/a").count() == 4
    sinks.write_csv_report(df.drop("trade_date"), f"{tmp_path}/c")
    assert readers.read_profile_csv(spark, f"{tmp_path}/c", "ts_code string, d string, x double").count() == 2
    sinks.write_json(df, f"{tmp_path}/j")
    assert spark.read.json(f"{tmp_path}/j").count() == 2


def test_glob_scan_and_missing_path(spark, tmp_path):
    df = spark.range(3)
    for name in ("factors_2023", "factors_2024", "other"):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    assert readers.read_table(spark, f"{tmp_path}/factors_*.parquet").count() == 6
    with pytest.raises(AnalysisException):
        readers.read_table(spark, f"{tmp_path}/nothing.parquet")


def test_latest_snapshot_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([("a", "20240101"), ("a", "20240201"), ("b", "20240201")], "ts_code string, snapshot_date string")
    sinks.write_table(df, f"{tmp_path}/s", partition_by=["snapshot_date"])
    latest = readers.latest_snapshot(spark.read.parquet(f"{tmp_path}/s"))
    assert latest.count() == 2


def test_compaction_prefers_trade_time_and_keeps_first(spark):
    a = spark.createDataFrame([("a", "t1", 1), ("a", "t2", 2)], "ts_code string, trade_time string, seq int")
    b = spark.createDataFrame([("a", "t1", 0.5), ("b", "t1", 9.0)], "ts_code string, trade_time string, seq double")
    got = sorted(map(tuple, increments.compact([a, b], ["seq"]).collect()))
    assert got == [("a", "t1", 0), ("a", "t2", 2), ("b", "t1", 9)]


def test_resume_needs_history(spark):
    df = spark.createDataFrame([("2024-03-01",)], "d string").select(F.to_date("d").alias("d"))
    assert increments.resume_date(df, "d") == "20240301"
    with pytest.raises(ValueError):
        increments.resume_date(df.where("d is null"), "d")


def test_profile_counts_nulls_zeros_and_infinities(spark):
    rows = [(0.0, "a"), (None, None), (float("inf"), "b"), (-2.0, "b")]
    got = {r["column"]: r for r in profile.profile(spark.createDataFrame(rows, "x double, s string"), "f").collect()}
    assert (got["x"].null_count, got["x"].zero_count, got["x"].inf_count, got["x"].min) == (1, 1, 1, -2.0)
    assert got["s"].null_pct == 25.0 and got["s"].q50 is None
    assert {r["column"] for r in profile.issues(profile.profile(spark.createDataFrame([(0.0,)], "z double"), "f")).collect()} == {"z"}


def test_group_totals_read_file_sizes(spark, sf_dir):
    t = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("nation", "region")}
    row = profile.group_totals(t, {"nation": "g", "region": "g"}).first()
    assert (row.files, row.rows) == (2, 30) and row.size_mb > 0


def test_group_totals_count_a_folder_of_parts_and_an_empty_table_once(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(f"{tmp_path}/a")
    spark.range(0).write.parquet(f"{tmp_path}/b")
    t = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in "ab"}
    row = profile.group_totals(t, {"a": "g", "b": "g"}).first()
    assert (row.files, row.rows) == (2, 10)


def test_column_contract_finds_near_names(spark):
    got = {r.name: (r.present, r.near_matches) for r in quality.column_contract(spark, ["roe_dt", "q_ocf_to_sale"], ["roe_dt", "q_ocf_to_sales", "x"]).collect()}
    assert got == {"roe_dt": (True, []), "q_ocf_to_sale": (False, ["q_ocf_to_sales"])}


def test_fingerprint_ignores_row_order_and_sees_changes(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, x double")
    one = quality.fingerprint(df, ["k"], "k", ["k", "x"]).first()
    assert one == quality.fingerprint(df.orderBy(F.desc("k")), ["k"], "k", ["k", "x"]).first()
    assert one != quality.fingerprint(df.withColumn("x", F.col("x") + 1), ["k"], "k", ["k", "x"]).first()


def test_cut_lineage_keeps_rows(spark):
    assert cut_lineage(spark.range(10)).count() == 10


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    v = StarViews(spark, sf_dir)
    bars = v.bars_60m().withColumn("trade_time", F.to_timestamp("trade_time"))
    bars.repartition(1).sortWithinPartitions("trade_time").write.parquet(f"{tmp_path}/bars")
    last = spark.createDataFrame([("zz", "2030-01-01 00:00:00", 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)], "ts_code string, trade_time string, open double, high double, low double, close double, vol double, amount double")
    last.withColumn("trade_time", F.to_timestamp("trade_time")).write.mode("append").parquet(f"{tmp_path}/bars")
    stream = spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{tmp_path}/bars")
    out = intraday_stream.daily_summary(intraday_stream.stream_bars(stream))
    q = out.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{tmp_path}/cp").option("path", f"{tmp_path}/out").trigger(availableNow=True).start()
    q.awaitTermination(180)
    cols = ["ts_code", "trade_date", "open_day", "close_day", "high_day", "low_day", "vol_total", "count", "vol_pm"]
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").where("ts_code <> 'zz'").select(cols).collect()))
    want = sorted(map(tuple, domains.daily_from_bars(domains.clean_bars(v.bars_60m())).select(cols).collect()))
    assert got == want
