"""Every registered query against its SQL statement, on the whole small tables."""

import os

import pytest

import __spark_entry__ as entry_point
from compare import duck, duck_rows, duck_schema, spark_rows
from tidewater import oracle, registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES = registry.QUERIES
SQL = oracle.statements()


@pytest.fixture(scope="module")
def con():
    c = duck(SF)
    yield c
    c.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(SQL) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert dict(df.dtypes) == duck_schema(con, SQL[name])
    assert spark_rows(df) == duck_rows(con, SQL[name])


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
