"""Driver contract: entry() runs; every query agrees with its DuckDB oracle (sf0.001)."""

import datetime as dt
import math

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E

from ruleloom import tpch

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _key(rows):
    return sorted((tuple(_norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").columns
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(tpch.QUERIES) == set(tpch.ORACLE_SQL)
    assert set(tpch.QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(tpch.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    s_idx = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    d_idx = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    got = _key([tuple(r[i] for i in s_idx) for r in df.collect()])
    exp = _key([tuple(r[i] for i in d_idx) for r in rel.fetchall()])
    assert got == exp
