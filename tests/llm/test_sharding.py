import zlib

from pyspark.sql import functions as F

from tidemark.llm.jump_shards import jump_hash, shard_rows


def jump(key, n):
    key, b, j = (key or 0) & (2**64 - 1), -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_hash_equals_the_published_loop(spark):
    keys = [0, 1, 2, 7, 12345, 2**31, 2**62 + 5, -1, -2**63, None]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 9, 100, 5000):
        got = {r["k"]: r["s"] for r in df.select("k", jump_hash(F.col("k"), n).alias("s")).collect()}
        assert got == {k: jump(k, n) for k in keys}


def test_growing_moves_rows_into_the_new_shard_only(spark):
    rows = shard_rows(spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")), 8).collect()
    moved = [r for r in rows if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {8} and 0.09 < len(moved) / len(rows) < 0.13
    for s in range(8):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))


def test_edge_rows(edge_docs, no_docs):
    rows = shard_rows(edge_docs, 8).collect()
    texts = [r["text"] for r in edge_docs.select("text").collect()]
    assert sorted(r["text_crc32"] for r in rows) == sorted(zlib.crc32((t or "").encode()) for t in texts)
    assert sorted(r["size"] for r in rows) == sorted(len((t or "").encode()) + 1 for t in texts)
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1
    assert all(r["shard"] == jump(r["doc_id"], 8) for r in rows)
    assert shard_rows(no_docs, 8).collect() == []


def test_text_keys(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y"), (None, None)], "doc_id string, text string")
    assert all(0 <= r["shard"] < 8 for r in shard_rows(df, 8).collect())
