import math

import duckdb
import pytest

from kinfold.plans.queries import ORACLE_SQL, QUERIES
from tests.conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def rows_of(columns, rows):
    plain = lambda v: ("nan" if math.isnan(v) else round(v, 5)) if isinstance(v, float) else v
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = rows_of(df.columns, df.collect())
    assert got
    if name in ORACLE_SQL:
        want = duck.sql(ORACLE_SQL[name])
        assert sorted(want.columns) == sorted(df.columns)
        assert got == rows_of(want.columns, want.fetchall())


def test_entry_and_names(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
