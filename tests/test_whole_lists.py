"""Queries over all pairs, series and price columns, against their DuckDB oracles."""

import duckdb
import pytest

import __spark_entry__ as entry
from suite import QUERIES
from suite.quality_queries import _PV
from tests.test_entry import table

NAMES = ["fx_on_local_calendar_all_pairs", "macro_asof_panel_all_series", "profile_clipping_suspects_all_columns", "profile_high_zero_and_null_all_columns"]

#: Columns of the bars and of the basics, which the features are made of.
INPUTS = ["open", "high", "low", "close", "pre_close", "turnover_rate_f", "volume_ratio"]


@pytest.mark.parametrize("name", NAMES)
def test_whole_list_matches_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = entry.queries()[name](spark, sf_dir)
    result = con.execute(entry.oracle_sql()[name])
    columns, rows = [d[0] for d in result.description], [tuple(r) for r in df.collect()]
    assert table(rows, df.columns) == table(result.fetchall(), columns)
    if name.startswith("fx"):
        assert {r[df.columns.index("ts_code")] for r in rows} == {r[0] for r in con.execute("SELECT DISTINCT upper(event_type) || '.FX' FROM events").fetchall()}
    if name.startswith("macro"):
        assert len(df.columns) == 6


def test_all_price_columns(spark, sf_dir):
    from suite.common import StarViews
    from tidepanel.plans import domains

    v = StarViews(spark, sf_dir)
    assert sorted(_PV) == sorted(set(domains.price_volume(v.daily_bars(), v.daily_basic()).columns) - {"ts_code", "trade_date", *INPUTS})


def test_content_hash_by_recomputation(spark, sf_dir):
    """Rows as JSON lists, doubles as chained 64-bit hashes of their bits; the parts of each row's SHA-256 are summed."""
    import hashlib
    import json
    import struct

    import xxhash

    def double_hash(x):
        seed = xxhash.xxh64_intdigest(struct.pack("<i", 0), seed=42)
        value = xxhash.xxh64_intdigest(struct.pack("<d", x), seed=seed)
        return str(value - (1 << 64) if value >> 63 else value)

    sums, rows = [0] * 4, spark.read.parquet(f"{sf_dir}/orders.parquet").collect()
    for r in rows:
        fields = [None if x is None else double_hash(x) if isinstance(x, float) else str(x.date()) if hasattr(x, "date") else str(x) for x in r]
        digest = hashlib.sha256(json.dumps(fields, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()
        for i in range(4):
            sums[i] += int(digest[15 * i : 15 * i + 15], 16)
    (got,) = QUERIES["content_fingerprint"](spark, sf_dir).collect()
    assert got["content_hash"] == "-".join(map(str, sums)) and got["rows"] == len(rows)
