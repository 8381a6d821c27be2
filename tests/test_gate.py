"""Every registered query against its SQL counterpart, on the smallest data."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import TABLES, rows_of

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def sql(sf):
    con = duckdb.connect()
    for table in TABLES:
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, sf, name):
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        assert got
        return
    result = sql.sql(ORACLES[name])
    assert sorted(result.columns) == sorted(df.columns)
    assert got == rows_of(list(result.columns), result.fetchall())


@pytest.mark.parametrize("name", ["staged_tables", "stream_late_rows", "validate_all"])
def test_query_on_values_at_the_bounds(spark, sf, tmp_path, name):
    """Values that break a rule of their own meet every kind of row of the feed."""
    con = duckdb.connect()
    con.sql(f"""COPY (SELECT * REPLACE (CASE event_id // 100 WHEN 0 THEN 0.0 WHEN 2 THEN 0.0
        WHEN 3 THEN 560.21 ELSE value END AS value) FROM '{sf}/events.parquet')
        TO '{tmp_path}/events.parquet' (FORMAT parquet)""")
    con.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet'")
    df = QUERIES[name](spark, str(tmp_path))
    result = con.sql(ORACLES[name])
    assert rows_of(df.columns, df.collect()) == rows_of(list(result.columns), result.fetchall())


def test_no_oracle_without_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry(spark).count() > 0
