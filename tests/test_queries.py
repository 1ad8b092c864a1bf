"""Every registered query with SQL against DuckDB on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(float(value)) if isinstance(value, float) else str(value)


def _comparable(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return [columns[i] for i in order], sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def test_every_sql_belongs_to_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    got = entry_points.queries()[name](spark, FOLDER)
    relation = duck.sql(entry_points.oracle_sql()[name])
    expected = _comparable(list(relation.columns), relation.fetchall())
    assert _comparable(got.columns, got.collect()) == expected
