"""Every registered query against its SQL counterpart in DuckDB, on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry

duckdb = pytest.importorskip("duckdb")
SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM read_parquet('{SF_DIR}/{file}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def ordered(rows):
    return sorted((tuple(plain(v) for v in row) for row in rows), key=repr)


def own_queries():
    """Those of the trade lake; the text-corpus operators have tests of their own."""
    return [name for name in entry.queries() if name not in entry._llm()[0]]


def test_each_query_has_an_oracle():
    assert set(own_queries()) <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", own_queries())
def test_query(spark, tables, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = tables.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(names)
    assert ordered(df.select(*names).collect()) == ordered(result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
