"""Every registered query against its SQL counterpart: names, types, rows."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from registry.oracles import ORACLES
from registry.queries import QUERIES
from tests.util import rows, sorted_rows

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = "region nation customer supplier part orders lineitem events".split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours = contract.queries()[name](spark, FOLDER)
    theirs = duck.execute(contract.oracle_sql()[name])
    types = {column[0]: str(column[1]) for column in theirs.description}
    assert {column: TYPES[kind] for column, kind in ours.dtypes} == types
    order = [column[0] for column in theirs.description]
    assert sorted_rows(rows(ours.select(*order))) == sorted_rows(theirs.fetchall())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
