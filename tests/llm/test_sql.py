"""The training-data queries that have SQL return its rows on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from shelfline.llm import registry
from tests.conftest import SAMPLE


def _plain(value):
    return round(value, 6) if isinstance(value, float) else bytes(value) if isinstance(value, (bytes, bytearray)) else value


@pytest.mark.parametrize("name", registry.oracle_sql())
def test_rows_match_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        duck.execute(f"create view {table} as select * from '{SAMPLE}/{table}.parquet'")
    result = duck.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    found = registry.queries()[name](spark, SAMPLE)
    assert sorted(found.columns) == sorted(columns)

    def counted(rows):
        return Counter(tuple(map(_plain, row)) for row in rows)

    assert counted(found.select(columns).collect()) == counted(result.fetchall())
