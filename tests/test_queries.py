"""Every registered query with a SQL counterpart, compared on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the generated tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def plain(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else repr(value)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query(spark, database, name):
    frame = entry_points.queries()[name](spark, FOLDER)
    columns = sorted(frame.columns)
    found = sorted(tuple(plain(row[c]) for c in columns) for row in frame.collect())
    if name not in entry_points.oracle_sql():
        assert found
        return
    cursor = database.execute(entry_points.oracle_sql()[name])
    names = [item[0] for item in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert found == sorted(tuple(plain(row[i]) for i in order) for row in cursor.fetchall())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())
