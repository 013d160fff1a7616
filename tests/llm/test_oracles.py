"""Queries against their DuckDB SQL on the driver tables."""

import duckdb
import pytest

from tidemark.llm import queries

from .conftest import SF


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SF)
    want = con.sql(queries.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    assert sorted(map(repr, (tuple(r[c] for c in order) for r in got.collect()))) == sorted(
        map(repr, want.project(", ".join(order)).fetchall()))


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))


def test_batch_settings_are_restored(spark):
    from tidemark.llm.common import small_batches

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    with small_batches(spark, 7):
        assert spark.conf.get(name) == "7"
    assert spark.conf.get(name) == before
