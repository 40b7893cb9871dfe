"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, rows_of

from .conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    result = duck.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, rows) == rows_of(columns, result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
