"""Bloom key index of batch folders: no key is ever missed, few folders are read for random ids."""

import random
from dataclasses import replace
from datetime import datetime, timedelta, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import tidemark.plans.runner as P
from tidemark.operators import key_index as K
from tidemark.operators.ledger import read_ledger
from tidemark.operators.merge import merge_insert
from tidemark.operators.quality import RowCountBetween
from tidemark.plans.tables import append, read_table
from tidemark.sources.synth import synth_transactions

from .test_runner import clock, dimension, enriched


def held(spark, index, values, kind, blocks):
    keys = spark.createDataFrame([(v,) for v in values], f"k {kind}")
    got = K.may_hold(index, K.placed_keys(keys, "k", [blocks])).select("key").collect()
    return {r["key"] for r in got}


@pytest.mark.parametrize("kind, make", [("long", lambda i: i * 2654435761 - 10**12), ("int", lambda i: i * 7919),
                                        ("string", lambda i: f"inv-{i}-ü")])
def test_present_keys_are_found_and_absent_ones_hardly_ever(spark, kind, make):
    n = 20_000
    rows = spark.createDataFrame([(make(i),) for i in range(n)] + [(None,)] * 3, f"k {kind}")
    blocks = K.blocks_for(n)
    index = K.build(rows, "k", blocks).cache()
    assert index.count() <= blocks and all(len(r["bitmap"]) == K.BLOCK_BITS // 8 for r in index.collect())
    present = [make(i) for i in range(0, n, 3)]
    assert held(spark, index, present, kind, blocks) == set(present)
    absent = [make(i) for i in range(n, 3 * n)]
    assert len(held(spark, index, absent, kind, blocks)) <= 12  # 40,000 keys at about 1 in 25,000
    index.unpersist()


def test_integer_widths_agree(spark):
    rows = spark.createDataFrame([(5,), (6,)], "k int")
    index = K.build(rows, "k", 1)
    assert held(spark, index, [5, 6, 7, 8], "long", 1) == {5, 6}


def test_filters_fold_onto_smaller_ones(spark):
    a = K.build(spark.range(0, 5000).toDF("k"), "k", 8)
    b = K.build(spark.range(5000, 6000).toDF("k"), "k", 2)
    both = K.folded(a.unionByName(b), 2).cache()
    assert both.count() <= 2
    assert held(spark, both, range(6000), "long", 2) == set(range(6000))
    both.unpersist()


@given(st.integers(0, 10**13))
@settings(max_examples=200, deadline=None)
def test_size_is_a_power_of_two_with_enough_bits(rows):
    n = K.blocks_for(rows)
    assert n & (n - 1) == 0 and n * K.BLOCK_BITS >= rows * K.KEY_BITS
    assert n == 1 or n * K.BLOCK_BITS < 2 * rows * K.KEY_BITS


def test_folders_without_a_key_are_not_read(spark, tmp_path):
    root = str(tmp_path / "index")
    rnd = random.Random(7)
    folders = {f"b{i}": rnd.sample(range(10**12), 400 * (i + 1)) for i in range(6)}
    sizes = {}
    for f, ids in folders.items():
        rows = spark.createDataFrame([(x,) for x in ids], "k long")
        sizes[f] = K.write_index(rows, "k", len(ids), f"{root}/batch_id={f}")
    keys = spark.createDataFrame([(folders["b1"][0],), (folders["b4"][7],), (-1,), (None,)], "k long")
    assert K.folders_that_may_hold(spark, root, sizes, keys, "k", "batch_id") == ["b1", "b4"]
    nothing = keys.filter("k is null")
    assert K.folders_that_may_hold(spark, root, sizes, nothing, "k", "batch_id") == []
    assert K.folders_that_may_hold(spark, root, {}, keys, "k", "batch_id") == []


def test_an_index_of_no_rows_holds_nothing(spark, tmp_path):
    root = str(tmp_path / "index")
    n = K.write_index(spark.createDataFrame([], "k long"), "k", 0, f"{root}/batch_id=b")
    keys = spark.range(3).toDF("k")
    assert K.folders_that_may_hold(spark, root, {"b": n}, keys, "k", "batch_id") == []


def test_probe_reads_only_the_needed_bitmaps(spark, tmp_path):
    root = str(tmp_path / "index")
    n = K.write_index(spark.range(500_000).toDF("k"), "k", 500_000, f"{root}/batch_id=b")
    index = K.read_index(spark, root, ["b"], "batch_id").filter(F.col("block").isin([3, 5]))
    p = index._jdf.queryExecution().executedPlan().toString()
    assert n == 512 and "PushedFilters: [In(block, [3,5])]" in p


def random_ids(seed):
    """Ids spread over the whole range, as the generator of the landing files draws them."""
    return F.abs(F.xxhash64(F.lit(seed), "id")) % 10**9


@pytest.fixture()
def lake(spark, tmp_path):
    c = P.PipelineConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / "lake"), max_files=1,
                         suite=(RowCountBetween(1, None),), min_records=1, key_index_min_rows=0)
    P.bootstrap(spark, c, dimension(spark))
    return c


def deliver(spark, c, name, seeds, n=200):
    out = None
    for seed in seeds:
        df = synth_transactions(spark.range(n), "id").coalesce(1).withColumn("id", F.monotonically_increasing_id())
        df = df.withColumn("invoiceid", random_ids(seed)).drop("id")
        out = df if out is None else out.unionByName(df)
    out.coalesce(1).write.parquet(f"{c.landing}/{name}")


def test_random_ids_probe_only_the_folders_that_hold_them(spark, lake):
    for i in range(4):
        deliver(spark, lake, f"f{i}", [i])
        assert P.run_batch(spark, lake, clock(i)).inserted == 200
    ledger = read_ledger(spark, lake.ledger_path)
    rows = ledger.filter("state = 'archived'").orderBy("batch_id").collect()
    assert all(r["key_blocks"] == 1 for r in rows)
    batches = [r["batch_id"] for r in rows]
    # every folder's range covers nearly everything
    assert all(r["key_min"] < 10**8 and r["key_max"] > 9 * 10**8 for r in rows)
    enr_t = lake.enriched_table(spark.read.parquet(f"{lake.root}/dimension").schema)
    again = spark.range(200).select(random_ids(2).alias("invoiceid"))
    target = P.probe_target(spark, enr_t, ledger, "current", 0, 10**9, lake.key_index_path, again)
    out = merge_insert(target, again, "invoiceid")
    assert {f.split("batch_id=")[1].split("/")[0] for f in target.inputFiles()} == {batches[2]}
    assert out.count() == 0
    # new ids: no folder is read at all
    fresh = spark.range(200).select(random_ids(99).alias("invoiceid"))
    assert P.probe_target(spark, enr_t, ledger, "current", 0, 10**9, lake.key_index_path, fresh).inputFiles() == []
    # without an index all folders are
    assert len({f.split("batch_id=")[1].split("/")[0] for f in
                P.probe_target(spark, enr_t, ledger, "current", 0, 10**9).inputFiles()}) == 4


def test_small_folders_are_probed_without_a_filter(spark, lake):
    c = replace(lake, key_index_min_rows=201)
    for i in range(2):
        deliver(spark, c, f"f{i}", [i])
        P.run_batch(spark, c, clock(i))
    assert all(r["key_blocks"] is None for r in read_ledger(spark, c.ledger_path).collect())
    deliver(spark, c, "f2", [0, 1, 2])
    assert P.run_batch(spark, c, clock(2)).inserted == 200


def test_redelivered_random_ids_are_inserted_once(spark, lake):
    for i, seeds in enumerate([[0], [1], [0, 2], [1, 2, 3]]):
        deliver(spark, lake, f"f{i}", seeds)
        assert P.run_batch(spark, lake, clock(i)).inserted == 200
    e = enriched(spark, lake)
    assert e.count() == 800 and e.select("invoiceid").distinct().count() == 800


def test_folders_without_an_index_are_always_probed(spark, lake):
    deliver(spark, lake, "f0", [0])
    P.run_batch(spark, replace(lake, key_index=False), clock(0))
    deliver(spark, lake, "f1", [1])
    P.run_batch(spark, lake, clock(1))
    enr_t = lake.enriched_table(spark.read.parquet(f"{lake.root}/dimension").schema)
    moved = read_table(spark, enr_t).limit(5).withColumn("invoiceid", F.col("invoiceid") + 10**10)
    append(enr_t, moved, batch_id="loaded-elsewhere")
    deliver(spark, lake, "f2", [0, 2])
    assert P.run_batch(spark, lake, clock(2)).inserted == 200


def test_a_crash_before_the_ledger_row_leaves_a_folder_that_is_probed(spark, lake, monkeypatch):
    deliver(spark, lake, "f0", [0])
    P.run_batch(spark, lake, clock(0))
    deliver(spark, lake, "f1", [1])

    def broken(*a, **k):
        raise RuntimeError("executor lost while the index was written")

    with monkeypatch.context() as m:
        m.setattr(P, "write_index", broken)
        with pytest.raises(RuntimeError):
            P.run_batch(spark, lake, clock(1))
    r = P.run_batch(spark, lake, clock(1) + timedelta(minutes=1))  # resumes the pending batch
    assert r.status == "loaded" and r.inserted == 200 and r.batch_time == datetime(2024, 3, 1, 1, tzinfo=timezone.utc)
    deliver(spark, lake, "f2", [0, 1])
    assert P.run_batch(spark, lake, clock(2)).inserted == 0
