import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm.pairwise_quality import FEATURES, features, fit_bradley_terry, quality_scores

SF = "/root/testdata/sf0.01"


def test_held_out_ranking(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality_scores(docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    good, bad = rows.score[rows.quality == 1].to_numpy(), rows.score[rows.quality == 0].to_numpy()
    assert len(bad) > 10 and (good[:, None] > bad[None, :]).mean() > 0.98
    assert (rows.predicted == rows.quality).mean() > 0.95
    assert ((rows.score >= 0.5) == (rows.predicted == 1)).all() and rows.score.between(0, 1).all()


def test_held_out_labels_are_not_used(spark):
    from tidemark.llm.common import held_out
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(map(tuple, quality_scores(docs, x).collect())) for x in (labels, turned))
    assert a == b


def test_weights_recover_preferences():
    rng = np.random.default_rng(2)
    truth = np.array([2.0, -1.0, 0.0])
    d = rng.normal(size=(20_000, 3))
    d *= np.where(rng.random(20_000) < 1 / (1 + np.exp(-d @ truth)), 1, -1)[:, None]
    assert np.allclose(fit_bradley_terry(d), truth, atol=0.1)


def test_features_of_a_batch_do_not_mix():
    texts = ["A b! c", None, "", "x x x x", "é|é|", "word " * 1000, "\n"]
    both = features(pa.array(texts, pa.string()))
    alone = np.vstack([features(pa.array([t], pa.string())) for t in texts])
    assert both.shape == (7, len(FEATURES)) and np.allclose(both, alone)
    assert both[3][FEATURES.index("echo")] == 0.75


def test_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (3, 0, 0), (4, 0, 0), (8, 0, 0), (9, 0, None), (None, 1, 0), (6, None, 0), (7, 5, 0), (-5, 1, 0),
                                    (5, 0, 1)], "doc_id long, quality int, toxic int")
    rows = quality_scores(edge_docs, labels).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert quality_scores(no_docs, labels).collect() == []
    none = quality_scores(edge_docs, labels.filter("1 = 0")).collect()
    assert {(r["score"], r["predicted"]) for r in none} == {(0.5, 1)}


def test_repeated_ids_keep_the_sample_bounded(spark, monkeypatch):
    from tidemark.llm import pairwise_quality as q

    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    hot = 3  # learnable; a third of all documents and labels
    same = docs.filter(f"doc_id = {hot}").crossJoin(spark.range(300)).withColumn("text", F.concat("text", F.col("id").cast("string"))).drop("id")
    many = labels.filter("quality is not null").limit(1).withColumn("doc_id", F.lit(hot).cast("long")).crossJoin(spark.range(300)).drop("id")
    seen = []
    real = q.expand
    monkeypatch.setattr(q, "expand", lambda x: seen.append(len(x)) or real(x))
    model = q.train(docs.unionByName(same), labels.unionByName(many), per_class=40)
    assert model is not None and 40 < seen[0] <= 80
    seen.clear()
    q.train(docs.unionByName(same), labels.unionByName(many))
    assert seen[0] <= 1000 + 300 * 2  # each different document once, not once per repeated label


def test_least_rows(spark):
    from tidemark.llm.common import least_rows

    df = spark.createDataFrame([("a", i % 50) for i in range(500)] + [("b", 7), (None, 1), (None, 1)], "g string, p int")
    assert sorted(map(tuple, least_rows(df, "g", "p", 3).collect()), key=repr) == sorted(
        [("a", 0), ("a", 1), ("a", 2), ("b", 7), (None, 1)], key=repr)


def test_every_label_counts(spark):
    """Weights and threshold equal those of all pairs made one by one, whatever the start."""
    from tidemark.llm import pairwise_quality as q

    rng = np.random.default_rng(5)
    words = ["tree", "stone", "mill", "x", "a", "Rain|", "#go", "OH!", "1999", "wheel."]
    # what is good depends on the text of most documents, not of all: no ranking is perfect
    rows = [(i, " ".join(rng.choice(words, 40 + i % 30, p=np.roll(np.linspace(1, 9, 10) / 50, 3 * (i % 5 == 0)))), int((i % 5 != 0) ^ (i % 7 == 0)))
            for i in range(900)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id long, quality int, toxic int")
    few, many = (q.train(docs, labels, per_class=n) for n in (15, 6000))
    assert np.allclose(few.weights, many.weights, atol=1e-3) and abs(few.threshold - many.threshold) < 1e-3
    learned = {r["doc_id"] for r in q.document_features(docs).filter("not held_out").collect()}
    rows = [r for r in rows if r[0] in learned]
    x, y = q.expand(features(pa.array([r[1] for r in rows]))), np.array([r[2] for r in rows])
    mean, spread = x.mean(axis=0), x.std(axis=0)
    spread[spread < 1e-9] = 1
    assert np.allclose(mean, many.mean) and np.allclose(spread, many.spread)
    z = (x - mean) / spread
    d = (z[y == 1][:, None] - z[y == 0][None]).reshape(-1, z.shape[1])
    scale = q.PAIRS_PER_DOCUMENT / min((y == 1).sum(), (y == 0).sum())
    plain = fit_bradley_terry(d, ridge=1 / scale)
    assert np.allclose(plain, many.weights, atol=1e-2)
    s = np.sort(z @ many.weights)
    i = (y == 0).sum()
    assert abs((s[i] + s[i - 1]) / 2 - many.threshold) < 1e-9


def test_score_quantile(spark):
    from tidemark.llm.pairwise_quality import score_quantile

    rows = [(0, 1.0), (0, 1.0), (0, 2.0), (0, 2.0 + 1e-12), (1, 3.0), (1, 1e6), (1, -1e6)]
    scored = spark.createDataFrame(rows, "quality int, score double")
    same = {0: 1.0, 1: 1.0}
    assert [score_quantile(scored, same, k / 7) for k in (0, 1, 2, 4, 6)] == [
        -1e6, (1.0 - 1e6) / 2, (1.0 - 1e6) / 2, (2.0 + 2.0 + 1e-12) / 2, (1e6 + 3.0) / 2]
    assert score_quantile(scored, {0: 0.5, 1: 2.0}, 0.25) == (1.0 - 1e6) / 2
    assert score_quantile(scored.filter("score = 1"), same, 0.5) == 1.0
