"""Compaction into an existing dataset: only touched partitions are rewritten."""

import os

from tidepanel.operators import increments


def files(path):
    return {p: sorted(n for n in os.listdir(f"{path}/{p}") if n.endswith(".parquet")) for p in os.listdir(path) if "=" in p}


def test_only_touched_partitions_change(spark, tmp_path):
    path, kinds = str(tmp_path / "bars"), "ts_code string, trade_date string, month string, close double, seq int"
    first = [(c, f"2024{m:02d}{d:02d}", f"m{m}", float(d), 1) for c in "abc" for m in (1, 2, 3) for d in (1, 2)]
    assert sorted(increments.compact_into(path, spark.createDataFrame(first, kinds), ["month"], ["ts_code", "trade_date"], ["seq"])) == [("m1",), ("m2",), ("m3",)]
    before = files(path)
    late = [("a", "20240201", "m2", 9.0, 2), ("a", "20240201", "m2", 8.0, 1), ("d", "20240209", "m2", 7.0, 1), ("b", "20240202", "m2", 5.0, 0)]
    assert increments.compact_into(path, spark.createDataFrame(late, kinds), ["month"], ["ts_code", "trade_date"], ["seq"]) == [("m2",)]
    after = files(path)
    assert after["month=m1"] == before["month=m1"] and after["month=m3"] == before["month=m3"] and after["month=m2"] != before["month=m2"]
    want = {(r[0], r[1]): r[3] for r in first} | {("a", "20240201"): 9.0, ("d", "20240209"): 7.0}
    got = spark.read.parquet(path)
    assert got.count() == len(want) and {(r.ts_code, r.trade_date): r.close for r in got.collect()} == want


def test_nothing_new_and_a_null_partition(spark, tmp_path):
    path, kinds = str(tmp_path / "bars"), "ts_code string, month string, close double, seq int"
    assert increments.compact_into(path, spark.createDataFrame([], kinds), ["month"], ["ts_code"], ["seq"]) == []
    assert not os.path.exists(path)
    increments.compact_into(path, spark.createDataFrame([("a", None, 1.0, 1), ("b", "m1", 1.0, 1)], kinds), ["month"], ["ts_code"], ["seq"])
    increments.compact_into(path, spark.createDataFrame([("a", None, 2.0, 1)], kinds), ["month"], ["ts_code"], ["seq"])
    assert {(r.ts_code, r.month, r.close) for r in spark.read.parquet(path).collect()} == {("a", None, 2.0), ("b", "m1", 1.0)}
