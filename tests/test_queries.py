"""Every registered query with SQL agrees with DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    out = check.compare(spark, con, name, SF, entry.queries(), entry.oracle_sql())
    assert out.startswith("ok"), out


PLAIN = sorted(n for n in set(entry.queries()) - set(entry.oracle_sql()) if not n.startswith("op") and n != "pipeline")


@pytest.mark.parametrize("name", PLAIN)
def test_query_without_sql(spark, con, name):
    out = check.compare(spark, con, name, SF, entry.queries(), entry.oracle_sql())
    assert out.startswith("rows-only"), out
