"""Every query that has SQL against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")
@pytest.mark.parametrize("name", sorted(n for n in __spark_entry__.oracle_sql() if not n.startswith("op")))
def test_query(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(__spark_entry__.oracle_sql()[name])
    there = [d[0] for d in result.description]
    assert sorted(there) == columns
    assert sorted(tuple(norm(r[there.index(c)]) for c in columns) for r in result.fetchall()) == got


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
