"""Every query against its SQL twin on the smallest tables."""

import math
import os

import pytest

from registry.oracle import ORACLE
from registry.queries import QUERIES

import __spark_entry__ as entry_point

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS FROM '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() == 25


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = entry_point.queries()[name](spark, SF_DIR)
    twin = duck.execute(entry_point.oracle_sql()[name])
    twin_columns = [c[0] for c in twin.description]
    assert sorted(result.columns) == sorted(twin_columns)
    found = table(result.columns, [tuple(r) for r in result.collect()])
    assert found == table(twin_columns, twin.fetchall())
    assert found
