import pytest

from tidemark.operators.merge import DuplicateSourceKey, merge_insert, merge_insert_table, merge_upsert


def kv(spark, rows):
    return spark.createDataFrame(rows, "invoiceid long, v string")


def test_insert_only_keeps_duplicates_and_null_keys(spark):
    target = kv(spark, [(1, "old"), (2, "old")])
    source = kv(spark, [(2, "new"), (3, "a"), (3, "b"), (None, "n1"), (None, "n2")])
    got = sorted(merge_insert(target, source, "invoiceid").collect(), key=lambda r: (r.invoiceid or -1, r.v))
    assert [(r.invoiceid, r.v) for r in got] == [(None, "n1"), (None, "n2"), (3, "a"), (3, "b")]


def test_broadcast_and_shuffle_paths_agree(spark):
    target = kv(spark, [(i, "t") for i in range(0, 50, 2)])
    source = kv(spark, [(i, "s") for i in range(30)] + [(7, "dup")])
    a = sorted(merge_insert(target, source, "invoiceid").collect())
    b = sorted(merge_insert(target, source, "invoiceid", max_rows=3).collect())
    assert a == b and len(a) == 16 and all(r.invoiceid % 2 == 1 for r in a)  # 15 odd keys + repeated 7


def test_semi_join_probe_is_map_side(spark):
    target = kv(spark, [(i, "t") for i in range(100)])
    source = kv(spark, [(5, "s"), (500, "s")])
    out = merge_insert(target, source, "invoiceid")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "LeftAnti" in plan and "BroadcastHashJoin" in plan
    assert [r.invoiceid for r in out.collect()] == [500]


def test_merge_twice_equals_once(spark):
    target = kv(spark, [(1, "a")])
    source = kv(spark, [(1, "b"), (2, "c"), (3, "d")])
    once = merge_insert_table(target, source, "invoiceid")
    twice = merge_insert_table(once, source, "invoiceid")
    assert sorted(once.collect()) == sorted(twice.collect())


def test_upsert(spark):
    target = kv(spark, [(1, "a"), (2, "b"), (None, "n")])
    source = kv(spark, [(2, "B"), (3, "C"), (None, "m")])
    got = sorted(merge_upsert(target, source, "invoiceid").collect(), key=lambda r: (r.invoiceid or -1, r.v))
    assert [(r.invoiceid, r.v) for r in got] == [(None, "m"), (None, "n"), (1, "a"), (2, "B"), (3, "C")]


def test_upsert_refuses_repeated_source_keys(spark):
    with pytest.raises(DuplicateSourceKey):
        merge_upsert(kv(spark, [(1, "a")]), kv(spark, [(1, "x"), (1, "y")]), "invoiceid")


def test_composite_keys(spark):
    t = spark.createDataFrame([(1, 1, "t"), (1, 2, "t")], "a long, b long, v string")
    s = spark.createDataFrame([(1, 2, "s"), (1, 3, "s")], "a long, b long, v string")
    assert [(r.a, r.b) for r in merge_insert(t, s, ["a", "b"]).collect()] == [(1, 3)]


def test_timestamp_and_string_keys(spark):
    from datetime import datetime

    t = spark.createDataFrame([(datetime(2024, 1, 1, 10), "a"), (datetime(2024, 1, 2, 10), "b")],
                              "k timestamp_ntz, v string")
    s = spark.createDataFrame([(datetime(2024, 1, 2, 10), "x"), (datetime(2024, 1, 3, 10), "y")],
                              "k timestamp_ntz, v string")
    assert [r.v for r in merge_insert(t, s, "k").collect()] == ["y"]
    ts = spark.createDataFrame([("inv-1", 1), ("inv-2", 2)], "k string, n int")
    ss = spark.createDataFrame([("inv-2", 9), ("inv-3", 9)], "k string, n int")
    out = merge_insert(ts, ss, "k")
    assert [r.k for r in out.collect()] == ["inv-3"]
    assert ">= inv-2" in out._jdf.queryExecution().executedPlan().toString()  # string range predicate
