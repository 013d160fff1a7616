"""Sketch profiles of batches, drift, and examples of violations."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import drift as D
from tidemark.operators.quality import Between, MatchRegex, NotNull, RowCountBetween, unexpected_samples, validate

from .conftest import plan_text


def exact(a, b):
    """Kolmogorov-Smirnov distance of two samples."""
    values = sorted({*a, *b})
    share = lambda s, v: sum(x <= v for x in s) / len(s)
    return max(abs(share(a, v) - share(b, v)) for v in values)


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double")


@pytest.mark.parametrize("make_a, make_b", [
    (lambda r: r.gauss(0, 1), lambda r: r.gauss(0, 1)), (lambda r: r.gauss(0, 1), lambda r: r.gauss(1, 1)),
    (lambda r: float(r.randrange(3)), lambda r: float(r.randrange(4))), (lambda r: 5.0, lambda r: 5.0),
    (lambda r: r.random(), lambda r: 10 + r.random())])
def test_distance_is_near_the_exact_one(spark, make_a, make_b):
    rnd = random.Random(4)
    a, b = [make_a(rnd) for _ in range(1500)], [make_b(rnd) for _ in range(900)]
    p = D.profile(frame(spark, a), ["x"], "1").unionByName(D.profile(frame(spark, b), ["x"], "2"))
    got = D.drift(p.filter("batch_id = '2'"), p).first()
    assert abs(got["distance"] - exact(a, b)) <= 0.025
    assert (got["rows"], got["before_rows"], got["nulls"]) == (900, 1500, 0)


def test_history_is_merged_from_sketches(spark):
    rnd = random.Random(5)
    parts = [[rnd.gauss(i, 1) for _ in range(400)] for i in range(4)]
    p = D.profile(frame(spark, parts[0]), ["x"], "0")
    for i in (1, 2, 3):
        p = p.unionByName(D.profile(frame(spark, parts[i]), ["x"], str(i)))
    rows = {r["batch_id"]: r for r in D.drift(p, p).collect()}
    assert rows["0"]["distance"] is None and not rows["0"]["drifted"] and rows["0"]["before_rows"] == 0
    for i in (1, 2, 3):
        want = exact(parts[i], [x for part in parts[:i] for x in part])
        assert abs(rows[str(i)]["distance"] - want) <= 0.03 and rows[str(i)]["drifted"]
    whole = D.merged(p).select("rows", F.hll_sketch_estimate("distinct").alias("d")).first()
    assert whole["rows"] == 1600 and abs(whole["d"] - 1600) < 80


def test_edge_batches(spark):
    nan = float("nan")
    p = D.profile(frame(spark, [1.0, None, nan]), ["x"], "a").unionByName(
        D.profile(frame(spark, [None, None]), ["x"], "b")).unionByName(D.profile(frame(spark, []), ["x"], "c"))
    rows = {r["batch_id"]: r for r in D.drift(p, p).collect()}
    assert (rows["a"]["rows"], rows["a"]["nulls"]) == (3, 2)
    assert (rows["b"]["rows"], rows["b"]["nulls"], rows["b"]["distance"], rows["b"]["drifted"]) == (2, 2, None, False)
    assert (rows["c"]["rows"], rows["c"]["before_rows"], rows["c"]["drifted"]) == (0, 5, False)


def test_profiles_are_stored_per_batch(spark, tmp_path):
    for _ in range(2):  # a replay replaces its own
        D.write_profile(D.profile(spark.range(50).selectExpr("id AS x", "id % 2 AS y"), ["x", "y"], "b1"), str(tmp_path / "p"), "b1")
    D.write_profile(D.profile(spark.range(100, 150).selectExpr("id AS x", "id % 2 AS y"), ["x", "y"], "b2"), str(tmp_path / "p"), "b2")
    p = D.read_profiles(spark, str(tmp_path / "p"))
    got = {(r["batch_id"], r["column_name"]): r["drifted"] for r in D.drift(p, p).collect()}
    assert got == {("b1", "x"): False, ("b1", "y"): False, ("b2", "x"): True, ("b2", "y"): False}


def test_one_scan_profiles_all_columns(spark, tmp_path):
    spark.range(100).selectExpr("id AS a", "id * 2 AS b", "id % 3 AS c").write.parquet(str(tmp_path / "t"))
    p = plan_text(D.profile(spark.read.parquet(str(tmp_path / "t")), ["a", "b", "c"], "x"))
    assert p.count("FileScan") == 1


SUITE = [RowCountBetween(1, 10), NotNull("k"), MatchRegex("s", "^[a-z]+$"), Between("n", 0, 10)]


def test_examples_of_violations(spark):
    rows = [(str(i) if i % 10 else None, "ab" if i % 3 else f"X{i}", i) for i in range(200)]
    df = spark.createDataFrame(rows, "k string, s string, n int")
    got = {r["column_name"]: r for r in unexpected_samples(df, SUITE, "k", 5).collect()}
    counts = {r["column_name"]: r["unexpected_count"] for r in validate(df, SUITE).collect() if r["column_name"]}
    assert {c: r["unexpected_count"] for c, r in got.items()} == counts
    assert [(x["key"], x["value"]) for x in got["k"]["examples"]] == [("", None)]  # one hash, so one slot
    for c, bad in (("s", {(k or "", s) for k, s, _ in rows if s != "ab"}), ("n", {(k or "", str(n)) for k, _, n in rows if n > 10})):
        found = [(x["key"], x["value"]) for x in got[c]["examples"]]
        assert 1 < len(found) <= 5 and set(found) <= bad and len(set(found)) == len(found)
    again = {r["column_name"]: r["examples"] for r in unexpected_samples(df.repartition(7), SUITE, "k", 5).collect()}
    assert again["s"] == got["s"]["examples"]  # the same, however the rows lie


def test_no_violations_no_examples_and_one_scan(spark, tmp_path):
    spark.range(10).selectExpr("cast(id AS string) AS k", "'ab' AS s", "cast(id AS int) AS n").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    out = unexpected_samples(df, SUITE, "k", 3)
    assert all(r["examples"] == [] and r["unexpected_count"] == 0 for r in out.collect())
    assert plan_text(unexpected_samples(df, SUITE, "k", 3)).count("FileScan") == 1
    assert all(r["examples"] == [] for r in unexpected_samples(df.limit(0), SUITE, "k", 3).collect())
