"""The registered queries: against SQL where there is any, and that they cover their whole table."""

import os

import duckdb
import pytest

from conftest import TESTDATA
from tidemark.llm.queries import QUERIES, SQL

SF = os.environ.get("CATALOGUE_SF", "sf0.001")
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{SF}/{name}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, duck, name):
    got = QUERIES[name](spark, f"{TESTDATA}/{SF}").toArrow()
    want = duck.execute(SQL[name]).to_arrow_table()
    columns = sorted(want.column_names)
    assert sorted(got.column_names) == columns
    rows = lambda t: sorted(zip(*(t.column(c).to_pylist() for c in columns), strict=True), key=repr)
    assert rows(got) == rows(want)
    assert {c: got.schema.field(c).type for c in columns} == {c: want.schema.field(c).type for c in columns}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_one_row_each(spark, name):
    table, key = ("pages", "page_id") if name.startswith("op6_") else ("documents", "doc_id")
    got = QUERIES[name](spark, f"{TESTDATA}/{SF}")
    ids = sorted(r[0] for r in got.select(key).collect())
    assert ids == sorted(r[0] for r in spark.read.parquet(f"{TESTDATA}/{SF}/{table}.parquet").select(key).collect())
