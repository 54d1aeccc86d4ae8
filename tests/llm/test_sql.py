"""Queries that SQL can express, against that SQL on the smallest tables."""

import duckdb
import pytest

from kinfold.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import DATA


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    want = con.sql(ORACLE_SQL[name])
    df = QUERIES[name](spark, DATA)
    assert sorted(map(tuple, df.select(*want.columns).collect())) == sorted(want.fetchall())
