"""Every registered query against its SQL specification on DuckDB (sf0.001)."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from lakevault.plans.standins import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "orders", "lineitem", "events", "documents"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.10g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
    assert len(QUERIES) >= 60


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["codigo", "valor_projeto"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got_cols = df.columns
    got = df.collect()
    rel = duck.sql(E.oracle_sql()[name])
    want_cols = rel.columns
    want = rel.fetchall()
    assert sorted(got_cols) == sorted(want_cols)
    order = sorted(range(len(got_cols)), key=lambda i: got_cols[i])
    dorder = [want_cols.index(got_cols[i]) for i in order]
    a = sorted((tuple(_norm(r[i]) for i in order) for r in got), key=repr)
    b = sorted((tuple(_norm(r[i]) for i in dorder) for r in want), key=repr)
    assert len(a) == len(b)
    assert a == b
