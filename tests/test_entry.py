"""The driver contract, and a sample of queries against their DuckDB oracles."""

import duckdb
import pytest

import __spark_entry__ as entry

SAMPLE = ["value_recovery", "domain_price_volume", "domain_intraday", "asof_join_time_sliced", "cs_rank_ordinal_split", "neutralize_industry_size", "column_profile", "month_code_batches", "option_lifecycle_checks", "tasks_per_code_year"]


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def cell(x):
        return "~" if x is None else repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "value_recovery" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 100


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    df = entry.queries()[name](spark, sf_dir)
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert table([tuple(r) for r in df.collect()], df.columns) == table(result.fetchall(), columns)
