import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import icws_dedup as I
from tidemark.llm.components import components
from tidemark.llm.wordhash import batches

from ..conftest import plan_text


def vectors(texts, weights):
    out = []
    for a, b, w in batches(pa.array(texts, pa.string())):
        out += [I.vector(w.hash[w.first[t]:w.first[t + 1]], weights) for t in range(b - a)]
    return out


def union(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(i) for i in range(n)]


def brute(rows, weights):
    """Class id per row from all pairs that share a shingle."""
    vec = vectors([t for _, t in rows], weights)
    holders = defaultdict(list)
    for i, (g, _) in enumerate(vec):
        for x in g.tolist():
            holders[x].append(i)
    pairs = {(a, b) for h in holders.values() for k, a in enumerate(h) for b in h[k + 1:]}
    links = [p for p in pairs if I.similarity(vec[p[0]], vec[p[1]]) >= I.SIMILARITY]
    equal = {}
    links += [(equal.setdefault(t, i), i) for i, (_, t) in enumerate(rows) if t is not None]
    roots = union(len(rows), links)
    ids = {}
    for (doc_id, _), r in zip(rows, roots):
        ids.setdefault(r, []).append(doc_id)
    return {d: min(v) for v in ids.values() for d in v}


def agree(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = I.near_duplicate_rows(docs).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute(rows, I.word_weights(docs))
    assert sum(r["stays"] for r in got) == len({r["class_id"] for r in got})
    return got


def test_classes_equal_brute_force(sample_docs):
    agree(sample_docs)


def test_copies_that_are_similar_to_the_original_only(spark):
    pick = random.Random(4)
    base = [f"w{pick.randrange(10**6)}" for _ in range(400)]
    rows = [(500, " ".join(base))]
    for i in range(60):  # each differs from the original in 6 places, from the others in 12
        w = list(base)
        for at in pick.sample(range(0, 400, 6), 6):
            w[at] = f"v{pick.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, " ".join(base[:20] + [f"u{pick.randrange(10**6)}" for _ in range(200)])) for i in range(60)]
    got = agree(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sum(r["class_id"] == 0 for r in got) == 61


def test_samples_agree_as_often_as_the_similarity():
    pick = np.random.default_rng(3)
    g = np.unique(pick.integers(0, 2**63, 900).astype(np.uint64))
    w = pick.uniform(1, 6, len(g))
    sampler = I.Sampler()
    for keep in (0.95, 0.8, 0.5):
        part = pick.random(len(g)) < keep
        other = np.where(pick.random(len(g)) < 0.2, w * 1.5, w)
        a, b = (g, w), (g[part], other[part])
        runs = [np.mean(I.Sampler(s).draw(*a) == I.Sampler(s).draw(*b)) for s in range(20)]
        assert abs(np.mean(runs) - I.similarity(a, b)) < 0.04
    assert (sampler.draw(g, w) == sampler.draw(g, w, piece=100)).all()


def test_weighted_similarity():
    a = (np.array([1, 2, 3], np.uint64), np.array([1.0, 2.0, 1.0]))
    b = (np.array([2, 3, 4], np.uint64), np.array([1.0, 3.0, 1.0]))
    assert I.similarity(a, b) == pytest.approx(2 / 7)


def test_components_equal_union_find(spark):
    pick = random.Random(9)
    edges = [(pick.randrange(300), pick.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    roots = union(461, edges)
    assert got == {n: roots[n] for e in edges if e[0] != e[1] for n in e}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_edge_rows(edge_docs, no_docs):
    rows = I.near_duplicate_rows(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    same = [r for r in rows if r["class_id"] == 1]
    assert len(same) == 4 and sum(r["stays"] for r in same) == 1 and {r["class_size"] for r in same} == {4}
    assert all(r["stays"] and r["class_size"] == 1 for r in rows if r["class_id"] != 1)
    out = I.deduplicated(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == sum(r["stays"] for r in rows)
    assert I.near_duplicate_rows(no_docs).collect() == [] and I.deduplicated(no_docs).collect() == []


def test_group_of_near_copies_that_are_not_similar_to_each_other(spark):
    """Many texts around one passage, most too far from all others, some in close pairs: the
    pairs compared stay few, and every similar pair is found."""
    pick = random.Random(8)
    base = [f"w{pick.randrange(10**6)}" for _ in range(200)]
    rows = []
    for i in range(150):
        w = list(base)
        for at in pick.sample(range(0, 200, 5), 3 + i % 10):
            w[at] = f"v{pick.randrange(10**6)}"
        rows.append((2 * i, " ".join(w)))
        if i % 5 == 0:
            w[7] = f"x{i}"
            rows.append((2 * i + 1, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    compared = []
    plain = I.links

    def counted(pairs, *rest):
        compared.append(pairs.distinct().count())
        return plain(pairs, *rest)

    I.links = counted
    try:
        agree(docs)
    finally:
        I.links = plain
    assert sum(compared) < len(rows) ** 2 / 8


def test_a_pair_that_is_filtered_is_compared_once(spark):
    weights = spark.sparkContext.broadcast((np.zeros(0, np.uint64), np.zeros(0), 1.0))
    pairs = spark.range(3).select(F.concat(F.lit("a b c d e "), F.col("id").cast("string")).alias("left"),
                                  F.lit("a b c d e 1").alias("right"))
    scored = pairs.select("left", I.similarity_column(F.col("left"), F.col("right"), weights).alias("similarity"))
    near = scored.filter(F.col("similarity") >= 0.8)
    assert [tuple(r) for r in near.collect()] == [("a b c d e 1", 1.0)]
    assert plan_text(near).count("compare(") == 1


def test_no_rows_come_from_local_lists(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"one two three four five six seven {i % 3}") for i in range(12)],
                                 "doc_id long, text string")

    def refuse(*args, **kwargs):
        raise AssertionError("rows of a local list start Python workers of their own")

    monkeypatch.setattr(type(spark), "createDataFrame", refuse)
    assert I.deduplicated(docs).count() == 3
