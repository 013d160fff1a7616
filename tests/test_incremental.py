"""Incremental roll-up, event-time de-duplication and Z-order clustering."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import rollup_state as S
from tidemark.operators import zorder as Z
from tidemark.operators.rollup import rollup_dimension
from tidemark.streaming.dedupe import drain_unique

COUNTY = "State string, `Sales.Total` int, `Income.Mean` int, note string"
VALUE = st.one_of(st.none(), st.integers(-5, 5))
ROWS = st.lists(st.tuples(st.sampled_from(["CA", "NY", None]), VALUE, VALUE, st.just("x")), max_size=6)


def plain(df):
    return sorted((repr(tuple(r)) for r in df.collect()))


@given(start=ROWS, more=ROWS, fixed=ROWS)
@settings(max_examples=8, deadline=None)
def test_deltas_equal_a_full_roll_up(spark, start, more, fixed):
    make = lambda rows: spark.createDataFrame(rows, COUNTY)
    gone = start[::2]
    state = S.combined(S.partial_state(S.signed(make(start), 1)))
    state = S.combined(state, S.partial_state(S.signed(make(more), 1)))
    state = S.combined(state, S.partial_state(S.corrections(make(gone), make(fixed))))
    left = [*start[1::2], *more, *fixed]
    assert plain(S.rollup_of(state)) == plain(rollup_dimension(make(left)))


def test_versions_are_applied_once(spark, tmp_path):
    path = str(tmp_path / "state")
    rows = spark.createDataFrame([("CA", 5, 10, "a"), ("CA", 7, 20, "b"), ("NY", 1, 2, "c")], COUNTY)
    assert S.read_state(spark, path) is None
    S.advance(spark, path, S.signed(rows, 1), 1)
    S.advance(spark, path, S.signed(rows, 1), 1)  # a retried delta
    state = S.advance(spark, path, S.signed(rows.filter("State = 'NY'"), -1), 2)
    assert [tuple(r) for r in S.rollup_of(state).collect()] == [("CA", 12, 15.0)]
    # a version whose write died (no commit marker) does not count and is written anew
    (tmp_path / "state" / "version=3").mkdir()
    assert S.rollup_of(S.read_state(spark, path)).count() == 1
    state = S.advance(spark, path, S.signed(rows.filter("State = 'CA'"), -1), 3)
    assert S.rollup_of(state).collect() == [] and S.read_state(spark, path).count() == 0


T0 = datetime(2024, 1, 1)


def test_stream_passes_each_key_once_and_drops_late_rows(spark, tmp_path):
    d = lambda n: T0 + timedelta(days=n)
    deliveries = [
        [(1, d(0)), (1, d(1)), (2, d(10)), (3, d(12))],
        [(2, d(10)), (4, d(13)), (5, d(1)), (3, d(30))],  # 5 is late (before d(12) - 5 days), 2 and 3 repeat
        [(6, d(31)), (4, d(13)), (7, d(24)), (None, d(32)), (None, d(33)), (8, None)],  # 7 is late, 8 has no time
    ]
    schema = "k long, at timestamp"
    for i, rows in enumerate(deliveries):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"d{i}"))
        drain_unique(spark, str(tmp_path / "in"), spark.createDataFrame([], schema).schema, str(tmp_path / "out"),
                     str(tmp_path / "ck"), ["k"], "at", "5 days")
    got = [r["k"] for r in spark.read.schema(schema).parquet(str(tmp_path / "out")).collect()]
    assert sorted(k for k in got if k is not None) == [1, 2, 3, 4, 6, 8] and got.count(None) == 1


def test_interleaved_bits():
    def by_hand(parts, bits):
        out = 0
        for i in reversed(range(bits)):
            for p in parts:
                out = out << 1 | (p >> i & 1)
        return out

    assert by_hand([0b10, 0b01], 2) == 0b1001
    with pytest.raises(ValueError):
        Z.interleave([F.lit(0)] * 8, 8)


def test_zorder_key_follows_both_columns(spark):
    rnd = random.Random(6)
    rows = [(rnd.randrange(10**6), T0 + timedelta(days=rnd.randrange(900))) for _ in range(2000)] + [(None, None)]
    df = spark.createDataFrame(rows, "k long, t timestamp")
    bounds = Z.range_bounds(df, ["t", "k"], 4)
    assert all(len(b) <= 15 for b in bounds.values())
    got = df.select("k", F.col("t").cast("timestamp").cast("double").alias("t"),
                    Z.zorder_key(df, ["t", "k"], 4, bounds).alias("z")).collect()
    for r in got:
        if r["k"] is None:
            assert r["z"] == 0
            continue
        at = Z.place_of({"t": r["t"], "k": float(r["k"])}, bounds)
        want = 0
        for i in reversed(range(4)):
            want = want << 2 | (at["t"] >> i & 1) << 1 | (at["k"] >> i & 1)
        assert r["z"] == want
    with pytest.raises(ValueError):
        Z.zorder_key(spark.createDataFrame([("a",)], "s string"), ["s"])


def files_read(df, condition):
    return df.filter(condition).select(F.input_file_name().alias("f")).distinct().count()


def files_needed(spark, path, column, lo, hi):
    """Files whose range of ``column`` (as parquet's statistics have it) meets [lo, hi]."""
    rows = (spark.read.parquet(path).groupBy(F.input_file_name().alias("f"))
            .agg(F.min(column).alias("lo"), F.max(column).alias("hi")).collect())
    return sum(r["lo"] <= hi and r["hi"] >= lo for r in rows), len(rows)


def test_a_predicate_on_either_column_skips_files(spark, tmp_path):
    rnd = random.Random(8)
    df = spark.createDataFrame([(rnd.randrange(1000), rnd.randrange(1000), i) for i in range(8000)], "a int, b int, v int")
    path = str(tmp_path / "z")
    Z.cluster_zorder(df, ["a", "b"], files=16).write.parquet(path)
    for c in ("a", "b"):
        needed, n = files_needed(spark, path, c, 400, 410)
        assert n == 16 and needed <= 8
    # sorted by (a, b), a predicate on b meets every file
    df.repartitionByRange(16, "a", "b").sortWithinPartitions("a", "b").write.parquet(str(tmp_path / "s"))
    assert files_needed(spark, str(tmp_path / "s"), "b", 400, 410)[0] == 16
    assert plain(spark.read.parquet(path)) == plain(df)


def test_equal_rows_spread_over_files(spark, tmp_path):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("a"), F.lit(1).alias("b"), F.col("id").alias("v"))
    path = str(tmp_path / "z")
    Z.cluster_zorder(df, ["a", "b"], files=12).write.parquet(path)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 3 * 9000 / 12
