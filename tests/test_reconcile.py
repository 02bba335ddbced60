"""Every registered query against its SQL, on the smallest of the driver's table sets."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from reconcile.registry import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in os.listdir(SMALL):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SMALL}/{name}'")
    return connection


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, oracle, name):
    found = driver.queries()[name](spark, SMALL)
    expected = oracle.execute(driver.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in expected.description}
    assert {c: TYPES[t] for c, t in found.dtypes} == types
    columns = sorted(types)
    order = [list(types).index(c) for c in columns]
    wanted = sorted((tuple(row[i] for i in order) for row in expected.fetchall()), key=repr)
    got = sorted((tuple(row[c] for c in columns) for row in found.collect()), key=repr)
    assert got == wanted and got


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert driver.entry(spark).count() == 6
