"""Every catalogue query against its DuckDB oracle at sf 0.001 (unordered rows)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from __spark_entry__ import CATALOGUE

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    return round(v, 9) if isinstance(v, float) and not math.isnan(v) else v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(CATALOGUE)))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(_norm(v) for v in r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in df.columns]
    expect = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    assert sorted(rows, key=_key) == sorted(expect, key=_key)


def test_every_query_has_an_oracle():
    assert set(CATALOGUE) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["invoiceid", "line", "processed_date", "state"]
