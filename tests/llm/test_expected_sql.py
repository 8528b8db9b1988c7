"""Queries with expected SQL, row by row."""

import duckdb
import pytest

from checks.compare import difference
from shelfwise.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", queries.oracle_sql())
def test_query(spark, con, name):
    assert difference(queries.queries()[name](spark, SF), con, queries.oracle_sql()[name]) is None
