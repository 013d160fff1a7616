"""Packing of batch folders in place: nothing is lost or doubled, whenever a run dies."""

from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import tidemark.plans.runner as P
from tidemark.operators.ledger import read_ledger
from tidemark.operators.quality import RowCountBetween
from tidemark.plans import compaction as C
from tidemark.plans.tables import append, read_table
from tidemark.sources.synth import synth_transactions

from .test_runner import clock, dimension, enriched


@pytest.fixture()
def lake(spark, tmp_path):
    c = P.PipelineConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / "lake"), max_files=1,
                         suite=(RowCountBetween(1, None),), min_records=1, key_index_min_rows=0)
    P.bootstrap(spark, c, dimension(spark))
    c = replace(c, dimension_schema=spark.read.parquet(f"{c.root}/dimension").schema)
    for i in range(3):
        deliver(spark, c, i, i * 100)
        assert P.run_batch(spark, c, clock(i)).inserted == 100
    return c


def deliver(spark, c, i, first):
    df = synth_transactions(spark.range(100), "id").coalesce(1)
    df.withColumn("invoiceid", F.monotonically_increasing_id() + F.lit(first)).write.parquet(f"{c.landing}/f{i}")


def folders(spark, c, table):
    return [n.split("=")[1] for n, d in P.child_entries(spark, table.path) if d and n.startswith("batch_id=")]


def tables(c):
    return c.raw_table(), c.enriched_table(c.dimension_schema)


def ids(spark, c):
    return sorted(r["invoiceid"] for r in enriched(spark, c).select("invoiceid").collect())


def test_pack_then_merge(spark, lake):
    raw, enr = tables(lake)
    before = sorted(map(repr, enriched(spark, lake).collect()))
    done = C.compact_lake(spark, lake)
    assert [len(p.folders) for p in done["raw"] + done["enriched"]] == [3, 3]
    assert len(folders(spark, lake, raw)) == len(folders(spark, lake, enr)) == 1
    assert sorted(map(repr, enriched(spark, lake).collect())) == before
    assert read_table(spark, raw).count() == 300
    # ids of the packed batches are known, and so is their range and index
    known = read_ledger(spark, lake.ledger_path).unionByName(C.as_ledger_rows(C.read_journal(spark, lake.root)))
    miss = spark.range(5000, 5010).select(F.col("id").alias("invoiceid"))
    assert P.probe_target(spark, enr, known, "now", 5000, 5009, lake.key_index_path, miss).inputFiles() == []
    assert P.probe_target(spark, enr, known, "now", 250, 260).count() == 300
    deliver(spark, lake, 7, 250)
    r = P.run_batch(spark, lake, clock(7))
    assert r.inserted == 50 and ids(spark, lake) == list(range(350))
    # a second packing takes the packed folder and the new one
    again = C.compact_lake(spark, lake)
    assert [len(p.folders) for p in again["enriched"]] == [2] and ids(spark, lake) == list(range(350))
    assert C.compact_lake(spark, lake) == {"raw": [], "enriched": []}


def test_large_folders_are_left_alone(spark, lake):
    raw, enr = tables(lake)
    sizes = {r["folder"]: r["bytes"] for r in C.folder_sizes(spark, enr, folders(spark, lake, enr)).collect()}
    assert C.plan_packing(spark, enr, sorted(sizes), target_bytes=min(sizes.values())) == []
    two = C.plan_packing(spark, enr, sorted(sizes), target_bytes=2 * max(sizes.values()) + 10)
    assert [p.folders for p in two] in ([tuple(sorted(sizes)[:2])], [tuple(sorted(sizes))])
    assert C.plan_packing(spark, enr, sorted(sizes)[:1]) == []


def test_rows_of_other_jobs_are_packed_only_once_merged(spark, lake):
    raw, enr = tables(lake)
    late = read_table(spark, raw).limit(5).withColumn("invoiceid", F.col("invoiceid") + 10**6)
    late = late.withColumn("processed_date", F.lit(clock(2) + timedelta(minutes=9)).cast("timestamp"))
    append(raw, late, "backfill-1", cluster="local")
    C.compact_lake(spark, lake)
    assert "backfill-1" in folders(spark, lake, raw)  # not merged yet: its rows are still to come
    deliver(spark, lake, 8, 300)
    assert P.run_batch(spark, lake, clock(8)).inserted == 105


STEPS = ["write", "index", "journal", "swap"]


@pytest.mark.parametrize("step", STEPS)
def test_a_run_that_dies_at_any_step(spark, lake, step):
    raw, enr = tables(lake)

    def dies(at):
        if at == step:
            raise RuntimeError("driver lost")

    with pytest.raises(RuntimeError):
        C.compact(spark, lake, enr, False, crash=dies)
    deliver(spark, lake, 9, 290)  # ten ids are known, whether the packing took place or not
    assert P.run_batch(spark, lake, clock(9)).inserted == 90
    assert ids(spark, lake) == list(range(390))
    assert len(folders(spark, lake, enr)) == (2 if step == "swap" else 4)
    C.compact_lake(spark, lake)
    assert ids(spark, lake) == list(range(390)) and len(folders(spark, lake, enr)) == 1


def test_a_run_that_dies_half_way_through_the_swap(spark, lake, monkeypatch):
    raw, enr = tables(lake)
    real, calls = C.delete_dir, []

    def dies(s, folder):
        if "batch_id=" in folder and "key_index" not in folder and "_packing" not in folder:
            calls.append(folder)
            if len(calls) == 2:
                raise RuntimeError("driver lost")
        real(s, folder)

    with monkeypatch.context() as m:
        m.setattr(C, "delete_dir", dies)
        with pytest.raises(RuntimeError):
            C.compact(spark, lake, enr, False)
    assert C.finish_compactions(spark, lake.root) == 1
    assert C.finish_compactions(spark, lake.root) == 0
    assert ids(spark, lake) == list(range(300)) and len(folders(spark, lake, enr)) == 1


def test_a_pending_batch_is_left_alone(spark, lake, monkeypatch):
    raw, enr = tables(lake)
    deliver(spark, lake, 6, 1000)

    def broken(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(P, "write_index", broken)
        with pytest.raises(RuntimeError):
            P.run_batch(spark, lake, clock(6))
    C.compact_lake(spark, lake)
    assert P.run_batch(spark, lake).inserted == 100  # resumed, its own folders replaced
    assert ids(spark, lake) == [*range(300), *range(1000, 1100)]
