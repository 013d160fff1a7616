"""Bucketed tables: merges without an exchange of the target, swaps that survive a crash."""

import uuid

import pytest
from pyspark.sql import functions as F

import tidemark.plans.bucketed as B
from tidemark.operators.merge import DuplicateSourceKey
from tidemark.plans.tables import SchemaMismatch

from .conftest import plan_text


@pytest.fixture()
def name(spark, tmp_path):
    space = "b" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE NAMESPACE {space} LOCATION '{tmp_path}/ns'")
    B.create_bucketed(spark, f"{space}.t", orders(spark, 0, 1000), "k", 4, f"{tmp_path}/t0")
    yield f"{space}.t"
    spark.sql(f"DROP NAMESPACE {space} CASCADE")


def orders(spark, lo, hi, v=1):
    return spark.range(lo, hi).select(F.col("id").alias("k"), F.lit(v).cast("long").alias("v"))


def content(spark, name):
    return {r["k"]: r["v"] for r in spark.table(name).collect()}


def without_exchange_on_target(spark, df):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan_text(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "SelectedBucketsCount: 4 out of 4" in p
    lines = p.splitlines()
    for i, ln in enumerate(lines):  # what is exchanged is the source, never the table
        if "Exchange" in ln:
            below = [x for x in lines[i + 1:i + 4] if "FileScan" in x or "Range" in x]
            assert below and "Range" in below[0], p


def test_merges_do_not_shuffle_the_target(spark, name):
    without_exchange_on_target(spark, B.unmatched(spark, name, orders(spark, 500, 1500, 2)))
    without_exchange_on_target(spark, B.upserted(spark, name, orders(spark, 500, 1500, 2)))


def test_upsert(spark, name):
    B.upsert_bucketed(spark, name, orders(spark, 900, 1100, 2))
    assert content(spark, name) == {k: 1 if k < 900 else 2 for k in range(1100)}
    assert B.bucket_spec(spark, name) == (["k"], 4)
    without_exchange_on_target(spark, B.unmatched(spark, name, orders(spark, 0, 10)))


def test_upsert_of_repeated_keys_is_refused(spark, name):
    s = orders(spark, 0, 5).union(orders(spark, 0, 1, 7))
    with pytest.raises(DuplicateSourceKey):
        B.upsert_bucketed(spark, name, s)
    with pytest.raises(SchemaMismatch):
        B.upsert_bucketed(spark, name, orders(spark, 0, 5).withColumn("x", F.lit(1)))
    assert content(spark, name) == {k: 1 for k in range(1000)}


def test_insert_keeps_buckets_and_compaction_joins_files(spark, name):
    for i in range(3):
        B.merge_insert_bucketed(spark, name, orders(spark, 500, 1100 + 100 * i, 2 + i))
    want = {k: 1 if k < 1000 else 2 if k < 1100 else 3 if k < 1200 else 4 for k in range(1300)}
    assert content(spark, name) == want
    before = {r["bucket"]: r["files"] for r in B.files_per_bucket(spark, name).collect()}
    assert set(before) == {0, 1, 2, 3} and all(n == 4 for n in before.values())
    B.compact_bucketed(spark, name)
    assert content(spark, name) == want
    assert all(r["files"] == 1 for r in B.files_per_bucket(spark, name).collect())


def test_null_keys_are_inserted(spark, name):
    s = spark.createDataFrame([(None, 5), (None, 6), (3, 9)], "k long, v long")
    B.merge_insert_bucketed(spark, name, s)
    assert spark.table(name).filter("k is null").count() == 2 and spark.table(name).count() == 1002


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_crash_around_the_swap(spark, name, monkeypatch, when):
    real = B.swap_location

    def dies(spark_, table, new):
        if when == "after":
            real(spark_, table, new)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(B, "swap_location", dies)
        with pytest.raises(RuntimeError):
            B.upsert_bucketed(spark, name, orders(spark, 990, 1010, 2))
    old, new = {k: 1 for k in range(1000)}, {k: 1 if k < 990 else 2 for k in range(1010)}
    assert content(spark, name) == (new if when == "after" else old)
    B.upsert_bucketed(spark, name, orders(spark, 990, 1010, 2))  # the retry
    assert content(spark, name) == new


def test_a_table_without_buckets_is_refused(spark, name):
    other = name.replace(".t", ".flat")
    orders(spark, 0, 3).write.saveAsTable(other)
    with pytest.raises(ValueError):
        B.bucket_spec(spark, other)
