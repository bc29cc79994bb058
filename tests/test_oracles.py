"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from natalis.plans.catalogue import QUERIES
from oracles import oracles

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def ordered(rows):
    return sorted((tuple(plain(v) for v in row) for row in rows), key=lambda r: [(v is None, str(v)) for v in r])


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracles())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    table = QUERIES[name](spark, SF)
    columns = sorted(table.columns)
    found = table.select(*columns).collect()
    result = duck.execute(f"SELECT {', '.join(columns)} FROM ({oracles()[name]})")
    assert [c[0] for c in result.description] == columns
    expected = result.fetchall()
    assert found
    assert ordered(found) == ordered(expected)


def test_entry(spark):
    assert entry.entry(spark).count() == 438
