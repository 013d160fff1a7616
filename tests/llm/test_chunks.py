import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm.chunk_dedup import MAX_CHUNK, MIN_CHUNK, chunk_table, cuts, gear, repeat_rows, without_repeats
from tidemark.llm.chunk_dedup import _GEAR, WINDOW

from .conftest import LONG, PROSE


def test_gear_equals_the_rolling_definition():
    data = np.frombuffer(PROSE.encode(), np.uint8)
    h, mask = 0, (1 << WINDOW) - 1
    rolled = []
    for b in data.tolist():
        h = ((h << 1) + int(_GEAR[b])) & mask
        rolled.append(h)
    got = (gear(data) & np.uint32(mask)).tolist()
    assert got[WINDOW:] == rolled[WINDOW:]


def test_an_insertion_changes_chunks_near_it_only():
    text = LONG.encode()[:50_000]
    changed = text[:20_000] + b"something new" + text[20_000:]

    def chunks(t):
        ends = cuts(np.frombuffer(t, np.uint8), np.array([0, len(t)]))
        return {t[a:b] for a, b in zip([0, *ends[:-1]], ends)}
    a, b = chunks(text), chunks(changed)
    assert len(a - b) <= 3 and len(b - a) <= 3


def test_chunks_tile_every_text(spark, edge_docs):
    docs = edge_docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(80, "a" * 5000), (81, "😀" * 3000), (82, "é"), (83, "ab" * 9000)], "doc_id long, text string"))
    chunks = chunk_table(docs)
    texts = sorted(r["text"] for r in docs.filter("text <> ''").select("text").collect())
    tiles = {}
    for r in chunks.collect():
        tiles.setdefault((r["uid"]), []).append((r["start"], r["end"], r["n_bytes"]))
    ends = []
    for t in tiles.values():
        t.sort()
        assert t[0][0] == 0 and all(x[1] == y[0] for x, y in zip(t, t[1:]))
        assert all(x[2] <= MAX_CHUNK for x in t) and all(x[2] >= MIN_CHUNK for x in t[1:-1])
        ends.append(t[-1][1])
    assert sorted(ends) == sorted(len(t) for t in texts)


def test_repeated_passages_of_fifty_words_are_found(sample_docs):
    texts = {r["doc_id"]: r["text"].split() for r in sample_docs.collect()}
    got = {r["doc_id"] for r in repeat_rows(sample_docs).collect()}

    def repeated(k, within):
        """Documents with a run of k words that another one has, or (within) that recurs at all."""
        seen, out = {}, set()
        for i, w in texts.items():
            for j in range(len(w) - k + 1):
                first = seen.setdefault(tuple(w[j:j + k]), (i, j))
                if first[0] != i or (within and first[1] != j):
                    out |= {i, first[0]}
        return out
    assert repeated(51, within=False) <= got <= repeated(15, within=True)


def test_removal_keeps_first_occurrences(spark):
    one = " ".join(f"alpha{i}" for i in range(300))
    two = " ".join(f"beta{i}" for i in range(300))
    docs = spark.createDataFrame([(1, one), (2, two + " " + one), (3, one), (4, "short one"), (5, "short one")],
                                 "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in without_repeats(docs).collect()}
    assert out[1] == one and out[3] == "" and out[4] == out[5] == "short one"
    assert out[2].startswith(two) and len(out[2]) < len(two) + 200
    rows = repeat_rows(docs).collect()
    assert {r["doc_id"] for r in rows} == {1, 2, 3} and {r["first_doc_id"] for r in rows} == {1}


def test_edge_rows(edge_docs, no_docs):
    rows = repeat_rows(edge_docs).collect()
    assert {r["doc_id"] for r in rows} == {1, 2, None}  # equal texts, and one that goes on
    out = without_repeats(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    assert out.filter("text is null").count() == 2
    assert out.filter((F.col("doc_id") == 6) & (F.col("text") == LONG)).count() == 1
    assert repeat_rows(no_docs).collect() == [] and without_repeats(no_docs).collect() == []


def test_shared_runs_of_a_short_period_are_found(spark):
    pick = random.Random(4)
    words = ["and", "der", "los", "mehr", "internationalization", "a b", "one two three", "über", "des mots qui reviennent",
             *["".join(pick.choices("abcdefghijklmnopqrstuvwxyz ", k=k)) for k in range(4, 40)]]

    def around():
        return " ".join("".join(pick.choices("abcdefghijklmnop", k=6)) for _ in range(20))
    docs = [(2 * i + j, f"{around()} {' '.join([w] * (60 + 9 * j))} {around()}") for i, w in enumerate(words) for j in (0, 1)]
    got = {r["doc_id"]: r for r in repeat_rows(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert set(got) == {i for i, _ in docs}


def test_ids_of_other_types(sample_docs):
    named = sample_docs.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 12, "0")))
    numbers = sorted((f"d{r[0]:012d}", *r[1:5], f"d{r[5]:012d}", r[6]) for r in repeat_rows(sample_docs).collect())
    assert numbers and numbers == sorted(tuple(r) for r in repeat_rows(named).collect())
    out = without_repeats(named)
    assert out.schema == named.schema and out.count() == named.count()
