"""Queries of the subpackage against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows_of
from opinions.llm import queries


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def test_one_query_for_each_operator():
    numbered = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbered == list(range(1, len(numbered) + 1)) and len(numbered) >= 10 and "pipeline" in entry.queries()
    assert set(queries.sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.sql()))
def test_query_equals_its_sql(spark, db, sf, name):
    df = entry.queries()[name](spark, sf)
    result = db.execute(entry.oracle_sql()[name])
    assert rows_of(df.columns, df.collect()) == rows_of([c[0] for c in result.description], result.fetchall())
