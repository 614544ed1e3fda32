"""Every registered query against its SQL on the same tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract
from conftest import TESTDATA
from tidemark.plans.catalogue import CATALOGUE

SF = os.environ.get("CATALOGUE_SF", "sf0.001")
TABLES = "region nation customer supplier part orders lineitem".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/{SF}/{name}.parquet'")
    yield con
    con.close()


def rows(frame: pd.DataFrame):
    frame = frame[sorted(frame.columns)]
    plain = [
        tuple(None if pd.isna(v) else v for v in row) for row in frame.itertuples(index=False)
    ]
    return sorted(plain, key=repr)


def kinds(table):
    names = {"int16": "int16", "int32": "int32", "int64": "int64", "date32[day]": "date"}
    return {f.name: names.get(str(f.type), str(f.type)) for f in table.schema}


def test_names_agree():
    assert set(CATALOGUE) <= set(contract.queries())
    assert set(CATALOGUE) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(CATALOGUE))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, f"{TESTDATA}/{SF}").toArrow()
    want = duck.execute(contract.oracle_sql()[name]).to_arrow_table()
    assert kinds(got) == kinds(want)
    assert got.num_rows == want.num_rows
    assert rows(got.to_pandas(date_as_object=True)) == rows(want.to_pandas(date_as_object=True))


def test_entry(spark):
    assert contract.entry(spark).count() > 0
