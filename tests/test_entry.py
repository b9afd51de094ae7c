"""Every registered query runs, and equals its SQL twin, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from catalog import models, regional, texts
from oracle import sql
from check import TABLES, rows_of

ORACLE = sql.queries()
QUERIES = {**regional.QUERIES, **texts.QUERIES, **models.QUERIES}


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def test_every_twin_has_a_query():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf, name):
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, df.collect())
    if name in ORACLE:
        result = db.execute(ORACLE[name])
        assert got == rows_of([c[0] for c in result.description], result.fetchall())
    else:
        assert got[1]


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
