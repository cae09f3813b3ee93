"""Every query of the corpus operators that has SQL against DuckDB, on the smallest tables, and the columns that the others promise."""

import os

import duckdb
import pytest

from marlstone.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables aren't here")
PROMISED = {
    "op2_token_files": {"doc_id", "start", "n_tokens", "ids_crc32"},
    "op4_licenses": {"doc_id", "license", "licenses"},
    "op5_fertility": {"doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"},
    "op10_secrets": {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"},
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def norm(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    result = duck.execute(ORACLES[name])
    there = [d[0] for d in result.description]
    assert sorted(there) == columns
    assert sorted(tuple(norm(r[c]) for c in columns) for r in df.collect()) == sorted(tuple(norm(r[there.index(c)]) for c in columns) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(PROMISED))
def test_columns_and_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert PROMISED[name] <= set(df.columns) and df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_every_operator_has_its_query():
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 11)) and "pipeline" in QUERIES
