import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle_manifest as M
from tidemark.llm.queries import op12_merkle_manifest

from .conftest import SF

COLS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def siblings(tree, i):
    out = []
    for nodes in tree[:-1]:
        first = i // 8 * 8
        run = nodes[first:first + 8]
        out.append(("".join(run[:i - first]), "".join(run[i - first + 1:])))
        i //= 8
    return out


def brute(docs):
    groups = defaultdict(list)
    for d in docs:
        text, key = d["text"], d["doc_id"]
        if text is not None and key is not None and zlib.crc32(str(key).encode()) % 3 == 0:
            text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        own = [field(d[f]) for f in ("doc_id", "source", "lang", "n_chars")]
        groups[d["lang"]].append((key is not None, key or 0, sha("".join([*own, field(d["text"])])),
                                  sha("".join([*own, field(text)]))))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: levels([x[2] for x in sorted(groups[g])]) for g in names}
    top = levels([trees[g][-1][0] for g in names])
    out = []
    for place, g in enumerate(names):
        for i, (known, key, leaf, other) in enumerate(sorted(groups[g])):
            path = siblings(trees[g], i) + siblings(top, place)
            folded = other
            for left, right in path:
                folded = sha(left + folded + right)
            out.append((key if known else None, leaf, trees[g][-1][0], top[-1][0],
                        sha("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return sorted(map(repr, out))


def rows(df):
    return sorted(repr(tuple(r[c] for c in COLS)) for r in df.collect())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = op12_merkle_manifest(spark, SF)
    assert rows(got) == brute(docs)
    assert any(r["verified"] for r in got.collect()) and not all(r["verified"] for r in got.collect())


def test_edge_rows(spark, edge_docs, no_docs):
    assert rows(M.manifest_rows(edge_docs)) == brute(edge_docs.collect())
    empty = M.manifest_rows(no_docs)
    assert empty.columns == COLS and empty.collect() == []


@pytest.mark.parametrize("counts", [[1], [8], [9], [1, 1], [64, 65], [1] * 9, [513, 2, 70]])
def test_uneven_trees(spark, counts):
    rnd = random.Random(sum(counts))
    data = [(rnd.randrange(10**6), f"T{rnd.random()}", f"l{g}", "s", 1) for g, n in enumerate(counts) for _ in range(n)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows(M.manifest_rows(df)) == brute(df.collect())


def test_requested_paths_only(spark):
    df = spark.range(700).select(F.lit("=x").alias("g"), F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 256).alias("leaf"))
    m = M.build(df, "doc_id")
    all_paths = {r["idx"]: r for r in M.paths(m).collect()}
    assert sorted(all_paths) == list(range(88))
    wanted = spark.createDataFrame([("=x", 3), ("=x", 87)], "g string, idx long")
    some = {r["idx"]: r for r in M.paths(m, wanted).collect()}
    assert some == {i: all_paths[i] for i in (3, 87)}


def test_one_changed_leaf_changes_every_root(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    changed = df.withColumn("text", F.when(F.col("doc_id") == 5, F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    a = {r["doc_id"]: r for r in M.manifest_rows(df).collect()}
    b = {r["doc_id"]: r for r in M.manifest_rows(changed).collect()}
    lang = df.filter("doc_id = 5").first()["lang"]
    assert len({r["root"] for r in a.values()}) == 1 and a[5]["root"] != b[5]["root"]
    for r in df.select("doc_id", "lang").collect():
        k = r["doc_id"]
        assert (a[k]["leaf"] == b[k]["leaf"]) == (k != 5)
        assert (a[k]["subroot"] == b[k]["subroot"]) == (r["lang"] != lang)


def test_equal_rows_get_a_proof_each(spark):
    data = [(1, "Same.", "en", "s", 5)] * 20 + [(2, "Other.", "en", "s", 6)]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    assert rows(M.manifest_rows(df)) == brute(df.collect())


def test_text_keys(spark):
    df = spark.createDataFrame([("b", "x", "en"), ("a", "y", "en"), (None, None, None)],
                               "doc_id string, text string, lang string")
    got = M.manifest_rows(df, fields=("doc_id", "lang", "text")).collect()
    assert {r["doc_id"] for r in got} == {"a", "b", None} and len({r["root"] for r in got}) == 1
