import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from scripts.compare import TABLES, difference


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    return connection


@pytest.mark.parametrize("name", sorted(entry_points.SQL))
def test_query_agrees_with_sql(spark, db, name):
    ours = entry_points.queries()[name](spark, SMALL).toPandas()
    assert difference(ours, db.execute(entry_points.oracle_sql()[name]).df()) is None


def test_every_query_has_its_sql():
    assert set(entry_points.QUERIES) == set(entry_points.SQL)
    assert set(entry_points.SQL) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
