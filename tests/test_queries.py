"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as registry
from compare import TABLES, rows_of

FOLDER = "/root/testdata/sf0.001"

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_as_sql(spark, con, name):
    df = registry.queries()[name](spark, FOLDER)
    result = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_every_sql_belongs_to_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_entry(spark):
    assert registry.entry(spark).count() > 0
