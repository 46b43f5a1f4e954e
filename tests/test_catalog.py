"""Registered queries against their DuckDB oracles on the smallest tables (the driver's gate, in pytest)."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.oracle_check import TABLES, canon

SF = "/root/testdata/sf0.001"
# The optional subpackage's queries have tests of their own.
NAMES = sorted(n for n in entry.oracle_sql() if not n.startswith("op"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, rows) == canon(ocols, res.fetchall())
    assert len(rows) > 0
