import hashlib
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import winnowing
from tidemark.llm.winnowing import decontaminate, decontamination_rows

from .conftest import PROSE, SF


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(10, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add("null" if item is None else str(item))
    sizes = {len(x) for x in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in sizes:
            for i in range(len(w) - k + 1):
                if s := windows.get(tuple(w[i:i + k])):
                    found |= s
                    hit |= set(range(i, i + k))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def result(df):
    return sorted(map(repr, (tuple(r)[:6] for r in df.collect())))


SPECIAL = [(900, "THE river-runs"), (901, ""), (902, None), (None, "Past the old STONE mill where nobody has ground any corn!"),
           (903, "the the the the the the the the the the the the"), (904, PROSE.upper())]


@pytest.mark.parametrize("block", [32 << 20, 2000])
def test_equals_brute_force(spark, sample_docs, edge_docs, block):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").unionByName(
        spark.createDataFrame(SPECIAL, "item_id long, text string"))
    docs = sample_docs.select("doc_id", "text").unionByName(edge_docs.select("doc_id", "text")).unionByName(
        spark.createDataFrame([(70, "the " * 50), (71, PROSE.replace("mill", "house") + ". " + PROSE)], "doc_id long, text string"))
    want = brute([tuple(r) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert result(decontamination_rows(docs, items, block)) == sorted(map(repr, want))


def test_any_shared_span_of_ten_words_is_found(spark):
    long = words(PROSE)
    items = spark.createDataFrame([(1, " ".join(f"q{i}" for i in range(9)) + " " + " ".join(long))], "item_id long, text string")
    docs = [(i, f"a{i} b{i} " + " ".join(long[i:i + 10]) + f" c{i} d{i}") for i in range(len(long) - 9)]
    rows = decontamination_rows(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert all(r["n_hit"] == 10 for r in rows)


def test_stage_and_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame(SPECIAL, "item_id long, text string")
    bad = {r["doc_id"] for r in decontamination_rows(edge_docs, items).collect() if r["contaminated"]}
    out = decontaminate(edge_docs, items)
    assert out.columns == edge_docs.columns and not bad & {r["doc_id"] for r in out.filter("doc_id is not null").collect()}
    assert decontamination_rows(no_docs, items).collect() == [] and decontaminate(no_docs, items).collect() == []
    nothing = items.filter(F.lit(False))
    assert decontaminate(edge_docs, nothing).count() == edge_docs.count()
    assert not any(r["contaminated"] for r in decontamination_rows(edge_docs, nothing).collect())


def test_stage_scans_few_texts_at_a_time(spark, monkeypatch):
    kind = winnowing._HITS_ARROW

    @F.arrow_udf(winnowing.HITS)
    def hit_in_large_batches(texts: pa.Array) -> pa.Array:
        spans = [{"s": 0, "e": 1}] if len(texts) > 256 else []
        return pa.array([{"n_words": 1, "spans": spans, "items": []}] * len(texts), kind)

    monkeypatch.setattr(winnowing, "hits", lambda text, block: hit_in_large_batches(text))
    docs = spark.range(0, 1000, 1, 1).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert decontaminate(docs, spark.createDataFrame(SPECIAL, "item_id long, text string")).count() == 1000
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_stage_by_blocks_and_repeated_texts(spark, edge_docs):
    items = spark.createDataFrame([(1, "nothing of this is there"), (2, PROSE), (3, "one two")], "item_id long, text string")
    found = [sorted(str(r) for r in decontaminate(edge_docs, items, n).collect()) for n in (1 << 20, 40)]
    assert found[0] == found[1]
    want = {r["doc_id"] for r in decontamination_rows(edge_docs, items).collect() if not r["contaminated"]}
    assert {r["doc_id"] for r in decontaminate(edge_docs, items).collect()} == want
