"""Scans over keys of any length: slices, halos, as-of joins and interval sweeps."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepanel.functions import timeseries as ts
from tidepanel.operators import pit, slices
from tidepanel.operators.ordered import exact_quantiles, running_levels
from tidepanel.operators.sliding import sliding_percentile
from tidepanel.session import cut_lineage


@pytest.fixture
def no_aqe(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_by_partition(df):
    used = [F.max(c).alias(f"_{c}") for c in df.columns]  # so that no column is pruned
    return [r["n"] for r in df.withColumn("p", F.spark_partition_id()).groupBy("p").agg(F.count("*").alias("n"), *used).collect()]


def hot_table(spark, n=200_000):
    """One key holds half of the rows; times repeat, one of them in a fifth of that key's rows."""
    key = F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 997).cast("string")))
    time = F.when(F.col("id") % 10 == 0, F.lit(5_000)).otherwise(F.pmod(F.xxhash64("id"), F.lit(10_000)))
    return spark.range(n, numPartitions=8).select(key.alias("k"), time.alias("t"), "id")


def test_half_the_rows_in_one_key_stay_even(no_aqe):
    left = hot_table(no_aqe)
    right = left.where("id % 7 = 0").select("k", F.col("t").alias("u"), F.col("id").alias("v"))
    joined = pit.asof_join(left, right, ["k"], "t", "u", ["v"], right_order=["v"])
    sizes = rows_by_partition(joined)
    assert sum(sizes) == 200_000 and max(sizes) <= 2 * sum(sizes) / 16
    want, last, order = {}, {}, []
    order += [(r.k, r.u, 0, r.v) for r in right.collect()] + [(r.k, r.t, 1, r.id) for r in left.collect()]
    for k, _, side, i in sorted(order):
        if side == 0:
            last[k] = i
        else:
            want[i] = last.get(k)
    assert {r.id: r.v for r in joined.collect()} == want


def test_halo_windows_stay_even_and_right(no_aqe):
    df = hot_table(no_aqe).withColumn("x", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)).cast("double"))
    columns = lambda w: {"lag3": ts.lag("x", 3, w), "mean20": ts.rolling_mean("x", 20, w), "next2": ts.forward_return("x", 2, w)}
    out = slices.over_rows(df, ["k"], ["t", "id"], columns, before=19, after=2)
    sizes = rows_by_partition(out)
    assert sum(sizes) == 200_000 and max(sizes) <= 2 * sum(sizes) / 16
    from pyspark.sql import Window

    plain = df.withColumns(columns(Window.partitionBy("k").orderBy("t", "id")))
    assert out.exceptAll(plain).count() == 0 and plain.exceptAll(out).count() == 0


@pytest.mark.parametrize(("before", "after", "longest"), [(1, 0, 1), (0, 1, 1), (3, 2, 1), (2, 7, 3), (50, 50, 2)])
def test_halos_wider_than_a_slice(spark, before, after, longest):
    """Slices of about one row, and frames that span many of them."""
    rng = random.Random(before * 10 + after)
    rows = [(k, t, float(rng.randrange(9))) for k, n in (("a", 60), ("b", 7), ("c", 1)) for t in range(n)] + [(None, 1, 1.0), (None, 2, 2.0)]
    df = spark.createDataFrame(rows, "k string, t int, x double").repartition(3)
    frame = lambda w: w.rowsBetween(-before, after)
    out = slices.over_rows(df.where("k IS NOT NULL"), ["k"], ["t"], lambda w: {"s": F.sum("x").over(frame(w)), "n": F.count("x").over(frame(w))}, before, after, longest=longest)
    want = Counter()
    for key in "abc":
        xs = [x for k, _, x in sorted(r for r in rows if r[0]) if k == key]
        for i, x in enumerate(xs):
            part = xs[max(0, i - before) : i + after + 1]
            want[(key, i, x, sum(part), len(part))] += 1
    assert Counter(map(tuple, out.collect())) == want


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 30), st.one_of(st.none(), st.integers(0, 9))), max_size=40), st.sampled_from([1, 4, None]))
def test_last_value_by_brute_force(spark, rows, longest):
    df = spark.createDataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(rows)], "k string, t int, i int, v int")
    stored = cut_lineage(df)
    got = {r.i: r.m for r in slices.last_value(slices.slice_keys(stored, ["k"], ["t", "i"], longest), ["k"], ["t", "i"], "v", "m").collect() if r.k}
    want, last = {}, {}
    for t, i, k, v in sorted((t, i, k, v) for i, (k, t, v) in enumerate(rows) if k):
        last[k] = v if v is not None else last.get(k)
        want[i] = last[k]
    assert got == want


def winner(intervals, at):
    return max(((s, e, p) for s, e, p in intervals if s is not None and e is not None and s <= at < e), default=(None,) * 3)[2]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.integers(0, 20)), st.one_of(st.none(), st.integers(0, 20)), st.sampled_from("pqr")), max_size=14))
def test_interval_sweep_by_brute_force(spark, rows):
    facts = spark.createDataFrame([(k, t) for k in "abc" for t in range(-1, 22)] + [(None, 3), ("a", None)], "k string, t int")
    found = pit.interval_range(facts, spark.createDataFrame(rows, "k string, s int, e int, p string"), "k", "t", "s", "e", ["p"])
    want = Counter({(k, t, winner([r[1:] for r in rows if r[0] == k], t)): 1 for k in "abc" for t in range(-1, 22)}) + Counter([(None, 3, None), ("a", None, None)])
    assert Counter(map(tuple, found.collect())) == want


def test_five_thousand_overlapping_intervals_of_one_key(no_aqe):
    rng = random.Random(7)
    rows = [("a", s := rng.randrange(50_000), s + rng.randrange(1, 20_000), f"p{i}") for i in range(5000)]
    facts = no_aqe.range(60_000).select(F.lit("a").alias("k"), F.col("id").cast("int").alias("t"))
    intervals = no_aqe.createDataFrame(rows, "k string, s int, e int, p string")
    segments = pit.disjoint_segments(intervals, "k", "s", "e", ["p"])
    sizes = rows_by_partition(segments)
    assert sum(sizes) <= 10_000 and max(sizes) <= 2 * sum(sizes) / 16
    found = pit.interval_range(facts, intervals, "k", "t", "s", "e", ["p"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any("Join" in line and "(t" in line and "k#" in line for line in plan.splitlines() if "Condition" in line)
    sample = {t: None for t in range(0, 60_000, 97)}
    got = {r.t: r.p for r in found.where(F.col("t") % 97 == 0).collect()}
    assert got == {t: winner([r[1:] for r in rows], t) for t in sample}


def test_empty_sides(spark):
    none = spark.createDataFrame([], "k string, t int, v int")
    one = spark.createDataFrame([("a", 1, 2)], "k string, t int, v int")
    assert pit.asof_join(none, one, ["k"], "t", "t", ["v"]).count() == 0
    assert pit.asof_join(one.select("k", "t"), none, ["k"], "t", "t", ["v"]).first().v is None
    assert pit.interval_range(one, none.withColumn("e", F.col("t")), "k", "t", "t", "e", ["v"]).count() == 1
    assert slices.over_rows(none, ["k"], ["t"], lambda w: {"x": ts.lag("v", 1, w)}, before=1).count() == 0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.one_of(st.none(), st.just(float("nan")), st.integers(-4, 4).map(float))), max_size=40), st.sampled_from([1, 3, 50]), st.sampled_from([1, 3]), st.sampled_from([None, 1, 6]))
def test_sliding_percentile_by_brute_force(spark, rows, k, least, longest):
    df = spark.createDataFrame([(key, i, x) for i, (key, x) in enumerate(rows)], "k string, i int, x double")
    got = {r.i: r.p for r in sliding_percentile(df, ["k"], ["i"], "x", k, "p", least, longest).collect()}
    want = {}
    for key in "ab":
        own = [(i, x) for i, (q, x) in enumerate(rows) if q == key]
        for at, (i, x) in enumerate(own):
            frame = [y for _, y in own[max(0, at - k + 1) : at + 1] if y is not None and y == y]
            want[i] = sum(y <= x for y in frame) / len(frame) if x is not None and x == x and len(frame) >= least else None
    assert got == want


def test_time_of_a_sliding_percentile_does_not_follow_its_width(spark):
    """Steps of the sorted frame are counted, not timed: one insert a row and one removal from the k-th on."""
    from tidepanel.operators import sliding

    import pyarrow as pa

    n, rng = 5000, random.Random(2)
    batch = pa.RecordBatch.from_pydict({"_first": [i == 0 for i in range(n)], "_halo": [False] * n, "_x": [rng.random() for _ in range(n)]})
    calls = Counter()
    real = (sliding.insort, sliding.bisect_left, sliding.bisect_right)
    try:
        for name, fn in zip(("insort", "bisect_left", "bisect_right"), real, strict=True):
            setattr(sliding, name, lambda *a, f=fn, m=name: (calls.update([m]), f(*a))[1])
        for k in (10, 252, 2000):
            calls.clear()
            list(sliding._shares(k, 1)([batch]))
            assert calls == {"insort": n, "bisect_right": n, "bisect_left": n - k}
    finally:
        sliding.insort, sliding.bisect_left, sliding.bisect_right = real


def test_signed_growth_and_weighted_quantiles(spark):
    returns = [None, 0.5, -3.0, None, 0.1, -1.5, -1.0, 4.0]
    df = spark.createDataFrame([("a", i, r) for i, r in enumerate(returns)], "ts_code string, trade_date int, r double")
    got = [r.g for r in df.select("trade_date", ts.cumulative_growth("r", ts.entity_window()).alias("g")).orderBy("trade_date").collect()]
    want, product = [], None
    for r in returns:
        product = product if r is None else (1.0 if product is None else product) * (1 + r)
        want.append(product)
    assert got[0] is None and got[1:] == pytest.approx(want[1:], rel=1e-12)
    levels = spark.createDataFrame([("g", 1.0, 3), ("g", 2.0, 1), ("g", 10.0, 2), ("g", None, 9), ("h", 5.0, 0)], "g string, v double, w int")
    (row,) = exact_quantiles(levels, ["g"], "v", {"a": 0.0, "b": 0.5, "c": 0.9}, weight="w").collect()
    plain = sorted([1.0] * 3 + [2.0] + [10.0] * 2)
    assert (row.a, row.b, row.c) == (1.0, (plain[2] + plain[3]) / 2, 10.0)
    points = spark.createDataFrame([("g", 0.5), ("g", 1.0), ("g", 9.0), ("g", 10.0), ("g", None), ("z", 1.0)], "g string, at double")
    shares = {(r.g, r.at): r.s for r in pit.share_at_or_below(points, running_levels(levels, ["g"], "v", "w"), ["g"], "at", "s").collect()}
    assert shares == {("g", 0.5): 0.0, ("g", 1.0): 0.5, ("g", 9.0): 4 / 6, ("g", 10.0): 1.0, ("g", None): None, ("z", 1.0): None}


def test_shares_and_quantiles_store_one_layout_or_nothing(spark, monkeypatch):
    from tidepanel.operators import ordered

    stored, cut = [], ordered.cut_lineage
    for module in (pit, ordered):
        monkeypatch.setattr(module, "cut_lineage", lambda df: stored.append(df) or cut(df))
    values = spark.createDataFrame([("g", 1.0), ("g", 1.0), ("g", 1.0), ("g", 2.0), ("g", 10.0), ("g", 10.0), ("g", None)], "g string, v double")
    points = spark.createDataFrame([(1, "g", 0.5), (2, "g", 1.0), (3, "g", 1.0), (4, "g", 9.0), (5, "g", 10.0), (6, "g", None), (7, "z", 1.0), (8, None, 1.0)], "i int, g string, at double")
    for plan, layouts in (("window", 0), ("split", 1), ("auto", 0)):  # the cost distribution stored values, then values and points, then looked up
        stored.clear()
        got = {r.i: (r.s, r.m) for r in pit.shares_and_quantiles(points, values, ["g"], "v", "at", "s", {"m": 0.5}, plan=plan).collect()}
        assert got == {1: (0.0, 1.5), 2: (0.5, 1.5), 3: (0.5, 1.5), 4: (4 / 6, 1.5), 5: (1.0, 1.5), 6: (None, 1.5), 7: (None, None), 8: (None, None)}
        assert len(stored) == layouts
