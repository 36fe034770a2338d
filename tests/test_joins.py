"""As-of and interval joins, deduplication, schema alignment."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.operators import dedup, pit
from tidepanel.plans import factors
from tidepanel.session import cut_lineage
from tidepanel.sources.star_views import StarViews


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("longest", [None, 1, 2])
def test_asof_keeps_null_payload_of_the_matched_row(spark, longest):
    left = frame(spark, [("a", day(2)), ("a", day(5)), ("a", day(9)), ("b", day(9))], "k string, t date")
    right = frame(spark, [("a", day(3), "x", 1), ("a", day(5), None, 2)], "k string, u date, p string, q int")
    got = {(r.k, r.t): (r.p, r.q) for r in pit.asof_join(left, right, ["k"], "t", "u", ["p", "q"], longest=longest).collect()}
    assert got == {("a", day(2)): (None, None), ("a", day(5)): (None, 2), ("a", day(9)): (None, 2), ("b", day(9)): (None, None)}


def test_a_panel_is_scanned_without_storing_it(spark, sf_dir, monkeypatch):
    """Keys bounded by the calendar: nothing is stored or counted, and the rows are those of the general scan."""
    v = StarViews(spark, sf_dir)
    basic, members, reports = v.daily_basic().select("ts_code", "trade_date", "pb"), v.industry_pit(), v.fina_indicator()
    stored = []
    monkeypatch.setattr(pit, "cut_lineage", lambda df: stored.append(1) or cut_lineage(df))
    panel = sorted(factors.point_in_time_panel(basic, members, reports, ["roe_dt"], report_tie=["report_type"]).collect())
    assert stored == []
    intervals = factors.membership_intervals(members)
    general = pit.interval_asof(basic, intervals, "ts_code", "trade_date", "in_date", "out_date", factors.INDUSTRY).drop("in_date", "out_date")
    known = factors.effective_reports(reports, ["roe_dt"], ["report_type"])
    assert panel == sorted(pit.asof_join(general, known, ["ts_code"], "trade_date", "ann_date", ["roe_dt", "ann_date"]).collect()) and stored


def test_bounded_asof_has_the_same_rules(spark):
    left = frame(spark, [("a", day(2)), ("a", day(5)), ("a", day(9)), (None, day(9)), ("b", None)], "k string, t date")
    right = frame(spark, [("a", day(3), "x", 1), ("a", day(5), "y", 1), ("a", day(5), None, 2), (None, day(1), "z", 3), ("b", None, "w", 4)], "k string, u date, p string, q int")
    one, two = (sorted(map(str, pit.asof_join(left, right, ["k"], "t", "u", ["p", "q"], right_order=["q"], bounded=b).collect())) for b in (False, True))
    assert one == two and len(one) == 5


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 60)), min_size=1, max_size=12, unique=True),
       st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 60)), max_size=12, unique=True))
def test_asof_matches_brute_force(spark, left, right):
    ldf = frame(spark, [(k, day(n)) for k, n in left], "k string, t date")
    rdf = frame(spark, [(k, day(n), n) for k, n in right], "k string, u date, v int")
    want = {(k, day(n)): max((m for kk, m in right if kk == k and m <= n), default=None) for k, n in left}
    for longest in (None, 1, 5):
        got = {(r.k, r.t): r.v for r in pit.asof_join(ldf, rdf, ["k"], "t", "u", ["v"], longest=longest).collect()}
        assert got == want


def test_asof_right_order_picks_the_last_of_a_day(spark):
    left = frame(spark, [("a", day(5))], "k string, t date")
    right = frame(spark, [("a", day(4), 1), ("a", day(4), 3), ("a", day(4), 2)], "k string, u date, v int")
    assert pit.asof_join(left, right, ["k"], "t", "u", ["v"], right_order=["v"]).first().v == 3


def test_interval_forms_on_gap_overlap_and_open_end(spark):
    facts = frame(spark, [("a", day(n)) for n in (0, 2, 6, 8, 20)], "ts_code string, trade_date date")
    iv = frame(spark, [("a", day(1), day(5), "p"), ("a", day(7), day(10), "q"), ("a", day(8), day(99), "r")], "ts_code string, s date, e date, n string")
    inner = {r.trade_date: r.n for r in pit.interval_asof(facts, iv, "ts_code", "trade_date", "s", "e", ["n"]).collect()}
    assert inner == {day(2): "p", day(8): "r", day(20): "r"}
    left = {r.trade_date: r.n for r in pit.interval_range(facts, iv, "ts_code", "trade_date", "s", "e", ["n"]).collect()}
    assert left == {day(0): None, day(2): "p", day(6): None, day(8): "r", day(20): "r"}
    blank = {r.trade_date: r.n for r in pit.interval_asof(facts, iv, "ts_code", "trade_date", "s", "e", ["n"], how="left").collect()}
    assert blank == left


def test_trailing_dates_exclude_the_anchor(spark):
    cal = frame(spark, [(day(n),) for n in (0, 1, 3, 7)], "trade_date date")
    anchors = frame(spark, [(day(7),), (day(0),)], "rebal_date date")
    got = sorted((r.rebal_date, r.trade_date) for r in pit.trailing_dates(anchors, cal, 2).collect())
    assert got == [(day(7), day(1)), (day(7), day(3))]


def test_same_day_reports_keep_the_latest_period(spark):
    rows = [("a", "20240105", "20231231", 2.0), ("a", "20240105", "20230930", 1.0), ("a", "bad", "20230930", 9.0)]
    got = factors.effective_reports(frame(spark, rows, "ts_code string, ann_date string, end_date string, roe double"), ["roe"]).collect()
    assert [(r.ann_date, r.roe) for r in got] == [(dt.date(2024, 1, 5), 2.0)]


def test_future_announcements_never_change_the_past(spark):
    basic = frame(spark, [("a", day(n)) for n in range(5)], "ts_code string, trade_date date")
    known = frame(spark, [("a", day(1), 1.0)], "ts_code string, ann_date date, roe double")
    more = known.unionByName(frame(spark, [("a", day(3), 2.0)], "ts_code string, ann_date date, roe double"))
    before = {r.trade_date: r.roe for r in pit.asof_join(basic, known, ["ts_code"], "trade_date", "ann_date", ["roe"]).collect()}
    after = {r.trade_date: r.roe for r in pit.asof_join(basic, more, ["ts_code"], "trade_date", "ann_date", ["roe"]).collect()}
    assert {k: v for k, v in before.items() if k < day(3)} == {k: v for k, v in after.items() if k < day(3)}
    assert after[day(4)] == 2.0


def test_keep_first_and_last(spark):
    df = frame(spark, [("a", 1, "x"), ("a", 2, None), ("b", 5, "z")], "k string, seq int, v string")
    assert sorted(map(tuple, dedup.keep_last(df, ["k"], ["seq"]).collect())) == [("a", 2, None), ("b", 5, "z")]
    assert sorted(map(tuple, dedup.keep_first(df, ["k"], ["seq"]).collect())) == [("a", 1, "x"), ("b", 5, "z")]


def test_duplicate_report_counts(spark):
    df = frame(spark, [("a", "d1", 1), ("a", "d1", 1), ("a", "d1", 2), ("b", "d1", 1)], "ts_code string, trade_date string, v int")
    assert tuple(dedup.duplicate_report(df).first()) == (4, 1, 2)
    empty = df.where("v > 9")
    assert tuple(dedup.duplicate_report(empty).first()) == (0, 0, 0)


def test_schema_alignment_and_big_integers(spark):
    a = frame(spark, [("a", 17409151)], "ts_code string, vol long").withColumn("note", F.lit(None))
    b = frame(spark, [("b", "n", 7)], "ts_code string, note string, extra int")
    out = dedup.union_aligned([a, b])
    assert out.schema["note"].dataType == T.StringType() and out.columns == ["ts_code", "vol", "note"]
    assert sorted(map(tuple, out.collect())) == [("a", 17409151, None), ("b", None, "n")]
    small = dedup.union_aligned([a, b], downcast=True)
    assert small.schema["vol"].dataType == T.FloatType() and small.where("vol is not null").first().vol == 17409152.0
