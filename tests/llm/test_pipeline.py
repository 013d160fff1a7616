"""The pipeline against an independent chain: SQL for four stages, all pairs for near-duplicates."""

import duckdb
import pandas as pd
import pytest

import corpus_pipeline
from tidemark.llm import icws_dedup, oracles, queries

from .conftest import SF
from .test_near_duplicates import brute


def test_run_equals_brute_force(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas()

    def after(sql, docs):
        con.register("documents", docs)
        return con.sql(sql).df()

    docs = docs[docs.doc_id.isin(after(oracles.OP4, docs).query("kept").doc_id)]
    weights = icws_dedup.word_weights(spark.createDataFrame(docs))
    classes = brute(list(zip(docs.doc_id, docs.text)), weights)
    docs = docs[docs.doc_id.isin(set(classes.values()))]
    docs = docs[docs.doc_id.isin(after(oracles.OP6, docs).query("not contaminated").doc_id)]
    mix = after(oracles.op8(corpus_pipeline.PIPELINE_MIX, queries._DOMAIN_SQL), docs)
    docs = docs[docs.doc_id.isin(mix[mix.copies > 0].doc_id)]
    want = after(oracles.OP5, docs).sort_values("doc_id").reset_index(drop=True)
    got = corpus_pipeline.run(spark, SF).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert 20 < len(got) < 190
    pd.testing.assert_frame_equal(got[sorted(got)], want[sorted(want)], check_dtype=False)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_edge_rows_and_empty_tables(spark, edge_docs, no_docs, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for docs in (edge_docs, no_docs):
        out = stage(spark, docs, SF)
        if name != "shards":
            assert out.columns == docs.columns
        assert out.count() <= docs.count()
