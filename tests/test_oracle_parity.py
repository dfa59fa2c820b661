"""Every registered query returns exactly the rows its SQL returns."""

import duckdb
import pytest

import __spark_entry__ as registered
from tests.conftest import SAMPLE

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
# The training-data queries that have SQL are compared with it in tests/llm.
QUERIES = {name: q for name, q in registered.queries().items() if name in registered._BUILDERS}
EXPECTED = {name: sql for name, sql in registered.oracle_sql().items() if name in QUERIES}
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SAMPLE}/{table}.parquet'")
    return connection


def _ordered(rows):
    return sorted(rows, key=lambda t: [(v is None, str(type(v)), v) for v in t])


def test_every_query_has_sql():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", QUERIES)
def test_rows_match(spark, duck, name):
    df = QUERIES[name](spark, SAMPLE)
    result = duck.execute(EXPECTED[name])
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()

    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    assert _ordered(tuple(r) for r in df.select(*types).collect()) == _ordered(expected)


def test_entry_returns_rows(spark):
    df = registered.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["warehouse_sk", "item_sk", "sold_wk_sk"]
