"""Joins of two large sides with hot keys."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.enrich import enrich
from tidemark.operators.merge import first_of_each_key, merge_insert
from tidemark.operators.skew import HotKeys, anti_join, hot_keys

from .conftest import plan_text


def skewed(spark, n=30_000):
    """Key -1 on a third of the rows, NULL on some."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 100 == 1, None).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))


def test_hot_keys_are_found_and_few(spark):
    hot = hot_keys(skewed(spark), ["k"])
    assert len(hot.hashes) == 1 and hot.rows(skewed(spark), ["k"]).select("k").distinct().collect()[0]["k"] == -1
    assert not hot_keys(spark.range(10_000).toDF("k"), ["k"])
    assert not hot_keys(spark.createDataFrame([], "k long"), ["k"])
    some = spark.range(1000).select((F.col("id") % 5).alias("k"), F.lit("x").alias("s"))
    assert len(hot_keys(some, ["k", "s"]).hashes) == 5  # several key columns, never more than 1 / share


def test_null_keys_are_never_hot(spark):
    df = spark.range(900).select(F.when(F.col("id") < 5, F.col("id")).alias("k"))
    hot = hot_keys(df, ["k"])
    assert hot.rows(df, ["k"]).filter("k is null").count() == 0
    assert hot.others(df, ["k"]).filter("k is null").count() == 895


def rows(df):
    return sorted((repr(tuple(r)) for r in df.collect()))


def test_anti_join_equals_the_plain_one(spark):
    source = skewed(spark, 6000)
    for target in (spark.range(0, 6000, 7).toDF("k"), spark.createDataFrame([(-1,), (-1,), (None,)], "k long"),
                   spark.createDataFrame([], "k long"), skewed(spark, 6000).select("k")):
        want = rows(source.join(target, "k", "left_anti"))
        assert rows(merge_insert(target, source, "k", max_bytes=1)) == want
        assert rows(anti_join(source, target, ["k"], HotKeys(()))) == want


def test_hot_rows_stay_out_of_the_shuffle(spark):
    source, target = skewed(spark), spark.range(0, 30_000, 7).toDF("k")
    hot = hot_keys(source, ["k"])
    cold = hot.others(source, ["k"])
    # no key is left that would fill a partition
    sizes = [r["count"] for r in cold.repartition(64, "k").groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2.5 * sorted(sizes)[len(sizes) // 2]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan_text(anti_join(source, target, ["k"], hot))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "BroadcastHashJoin" in p and "LeftAnti, BuildRight" in p


def test_enrichment_with_hot_keys_equals_the_plain_join(spark):
    facts = skewed(spark, 3000).select(F.col("v").alias("invoiceid"), F.col("k").cast("string").alias("state"))
    dim = spark.range(-1, 3000, 2).select(F.col("id").cast("string").alias("state_abbreviation"), F.col("id").alias("n"))
    want = rows(facts.join(dim, facts.state == dim.state_abbreviation, "left").select("invoiceid", "state", "n"))
    assert rows(enrich(facts, dim, max_bytes=1).select("invoiceid", "state", "State_n")) == want


KEYS = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 5)), max_size=12)


@given(source=KEYS, target=KEYS)
@settings(max_examples=12, deadline=None)
def test_dedupe_source(spark, source, target):
    s = spark.createDataFrame(source, "k long, v long")
    t = spark.createDataFrame(target, "k long, v long")
    known = {k for k, _ in target if k is not None}
    least = {}
    for k, v in source:
        if k is not None and k not in known:
            least[k] = max(v, least.get(k, v))
    want = sorted([*((k, v) for k, v in least.items()), *((k, v) for k, v in source if k is None)], key=repr)
    got = merge_insert(t, s.withColumn("o", -F.col("v")), "k", dedupe_source=True, dedupe_order=["o"]).select("k", "v")
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_a_very_often_repeated_key_is_combined_before_the_shuffle(spark):
    p = plan_text(first_of_each_key(skewed(spark), "k"))
    assert p.index("partial_min") > 0


def test_without_dedupe_repeated_rows_are_kept(spark):
    s = spark.createDataFrame([(1, 1), (1, 1), (2, 1)], "k long, v long")
    assert merge_insert(spark.createDataFrame([(2,)], "k long"), s, "k").count() == 2
    with pytest.raises(Exception):
        first_of_each_key(s, "missing").collect()
