import re

from pyspark.sql import functions as F

from tidemark.llm.adaptive_quality import Fences, quality_filter, quality_rows


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    where = {}
    for i in range(len(words) - 7):
        where.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + k for at in where.values() if len(at) > 1 for i in at for k in range(8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(edge_docs, sample_docs):
    for docs in (edge_docs, sample_docs):
        got = sorted(tuple(r)[1:6] for r in quality_rows(docs).collect())
        assert got == sorted(counts(r["text"]) for r in docs.select("text").collect())


def test_overlapping_repeats(spark):
    text = " ".join(["a b c d e f g h"] * 3 + ["x"] * 20 + ["a b c d e f g h i"])
    docs = spark.createDataFrame([(1, text, "en", "s")], "doc_id long, text string, lang string, source string")
    assert tuple(quality_rows(docs).first())[1:6] == counts(text)


def test_fences_adapt_to_the_group(spark):
    clean = "some plain words stand here and say nothing odd at all about any thing in the whole wide world today"
    noisy = " ".join(w + "&&" for w in clean.split())
    rows = [(i, clean + f" {i}", "en", "plain") for i in range(300)]
    rows += [(1000 + i, noisy + f" {i}", "en", "markup") for i in range(300)]
    rows += [(5000, noisy, "en", "plain")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in quality_rows(docs).collect()}
    assert not kept[5000] and all(kept[i] for i in kept if i != 5000)
    assert {r["doc_id"] for r in quality_filter(docs).collect()} == {i for i in kept if kept[i]}


def test_small_groups_take_the_merged_sketch(spark):
    clean = "some plain words stand here and say nothing odd at all about any thing in the whole wide world today"
    rows = [(i, clean + f" {i}", "en", "big") for i in range(300)] + [(900, " ".join("&&" + w for w in clean.split()), "en", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert not quality_rows(docs).filter("doc_id = 900").first()["kept"]
    alone = quality_rows(docs, Fences(min_rows=1)).filter("doc_id = 900").first()
    assert alone["kept"]  # with a sketch of its own it is nothing unusual


def test_edge_rows(edge_docs, no_docs):
    rows = quality_rows(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 20)
    out = quality_filter(edge_docs)
    assert out.columns == edge_docs.columns
    assert out.count() == sum(r["kept"] for r in rows)
    assert quality_rows(no_docs).collect() == [] and quality_filter(no_docs).collect() == []
    assert quality_filter(edge_docs.withColumn("lang", F.lit(None).cast("string"))).columns == edge_docs.columns
