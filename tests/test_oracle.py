"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry_module
from check import difference, sql_rows

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry_module.queries(), entry_module.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, key):
    df = QUERIES[key](spark, FOLDER)
    rows = [tuple(row) for row in df.collect()]
    if key not in ORACLES:
        assert rows
        return
    assert difference(df.columns, rows, *sql_rows(FOLDER, ORACLES[key])) is None


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns and df.count() > 0
