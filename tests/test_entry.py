"""Every registered query against its SQL, as the driver does it."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

from conftest import rows

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.registry.QUERIES))
def test_query_equals_sql(spark, oracle, name):
    ours = entry.queries()[name](spark, SF_DIR)
    theirs = oracle.sql(entry.oracle_sql()[name])
    order = sorted(theirs.columns)
    assert sorted(ours.columns) == order
    places = [theirs.columns.index(column) for column in order]
    expected = sorted(tuple(str(row[i]) for i in places) for row in theirs.fetchall())
    assert rows(ours) == expected


def test_flagship(spark):
    assert entry.entry(spark).count() == 10
