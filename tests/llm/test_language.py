import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm.langid import best_temperature, language_rows, predict, softmax, train

from .conftest import SF


def test_held_out_accuracy_and_calibration(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = language_rows(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    right = rows["lang"] == rows["lang_pred"]
    assert len(rows) > 250 and right.mean() > 0.98
    assert rows["score"].between(0, 1).all() and abs(rows["score"].mean() - right.mean()) < 0.05


def test_labels_of_held_out_rows_are_not_used(spark, sample_docs):
    from tidemark.llm.common import held_out
    docs = sample_docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert {r["lang_pred"] for r in language_rows(docs).collect()} <= {"en", "de", "fr", "es", "und"}


def test_weights_are_sparse(sample_docs):
    model = train(sample_docs)
    assert model.languages == ["de", "en", "es", "fr"] and 0 < (model.weights != 0).mean() < 0.2


def test_texts_of_a_batch_do_not_mix(sample_docs):
    m = train(sample_docs)
    texts = ["the and", None, "", "12 34", "und der", "é", "x" * 50_000]
    together = predict(pa.array(texts), m.languages, m.weights, m.bias, m.temperature).to_pylist()
    alone = [predict(pa.array([t], pa.string()), m.languages, m.weights, m.bias, m.temperature).to_pylist()[0] for t in texts]
    assert [t["lang"] for t in together] == [t["lang"] for t in alone]
    assert np.allclose([t["score"] for t in together], [t["score"] for t in alone])
    assert [t["lang"] for t in together][1:4] == ["und"] * 3


def test_temperature_softens_overconfident_logits():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 3, 4000)
    logits = np.eye(3)[np.where(rng.random(4000) < 0.8, labels, rng.integers(0, 3, 4000))] * 20
    t = best_temperature(logits, labels)
    p = softmax(logits / t).max(axis=1).mean()
    assert t > 3 and abs(p - (logits.argmax(axis=1) == labels).mean()) < 0.02


def test_edge_rows(edge_docs, no_docs):
    rows = language_rows(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(r["lang_pred"] in ("en", "de", "fr", "und") and 0 <= r["score"] <= 1 for r in rows)
    none = language_rows(edge_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    assert language_rows(no_docs).collect() == []
    assert SF


def test_repeated_ids_keep_the_sample_bounded(spark, sample_docs, monkeypatch):
    from tidemark.llm import langid as l

    hot = (sample_docs.filter("doc_id = 3").drop("text").crossJoin(spark.range(200))
           .withColumn("text", F.concat(F.lit("word number "), F.col("id").cast("string"))).drop("id"))
    twice = sample_docs.unionByName(hot).unionByName(hot)
    seen = []
    real = l.fit_ftrl
    monkeypatch.setattr(l, "fit_ftrl", lambda rows, y, *a, **k: seen.append(np.bincount(y).tolist()) or real(rows, y, *a, **k))
    l.train(twice, per_language=30)
    assert sum(seen[0]) <= 4 * 30 and max(seen[0]) <= 30


def test_only_the_most_frequent_languages_are_learned(spark, sample_docs, monkeypatch):
    from tidemark.llm import langid as l

    monkeypatch.setattr(l, "MAX_LANGUAGES", 4)
    dirty = sample_docs.withColumn("lang", F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("x"), F.col("doc_id").cast("string")))
                                   .otherwise(F.col("lang")))
    assert l.train(dirty).languages == ["de", "en", "es", "fr"]
