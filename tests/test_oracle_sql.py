"""Every oracle SQL string runs in DuckDB on the smallest data set, and every
oracle key names a registered query."""
import os

import duckdb
import pytest

import __spark_entry__ as E
from horizonkit.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_oracle_sql_runs(con, name):
    con.execute(f"CREATE OR REPLACE VIEW checked AS {E.oracle_sql()[name]}")  # a statement that cannot be a view is not compared
    rel = con.execute("SELECT * FROM checked")
    cols = [d[0] for d in rel.description]
    assert len(cols) == len(set(c.lower() for c in cols))
    rel.fetchall()
