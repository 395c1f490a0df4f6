"""Every query with reference SQL gives the same rows as DuckDB on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from check import TABLES, as_bag

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{FOLDER}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows_as_sql(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    result = duck.execute(contract.oracle_sql()[name])
    expected = as_bag([d[0] for d in result.description], result.fetchall())
    assert as_bag(df.columns, df.collect()) == expected


def test_every_sql_belongs_to_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_returns_a_frame(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "o_custkey"
