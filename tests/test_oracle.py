"""Every registered query against its DuckDB oracle on the small tables."""

import pytest

import __spark_entry__ as entry
from oracle_check import _rows, duck

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_named_in_sql_exists():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    if name not in SQL:
        assert len(rows) > 0
        return
    rel = con.sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    drows = rel.fetchall()
    assert len(rows) == len(drows)
    assert _rows(df.columns, rows) == _rows(rel.columns, drows)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["cheaper_option", "count"]
    assert df.count() > 0
