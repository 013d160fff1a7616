"""Physical-plan properties that matter at scale (checked on small data)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tidemark.operators.merge import merge_insert
from tidemark.operators.sizing import measure
from tidemark.plans.tables import Table, append, create_table, read_batch, read_table
from tidemark.schemas import RAW_SCHEMA

SF = "/root/testdata/sf0.001"
# queries that only read (no table writes), so building them is cheap
READ_ONLY = ["flagship_enrich_merge", "epoch_to_ts", "derive_date_parts", "month_partition", "rename_projection",
             "incremental_filter", "incremental_subquery", "incremental_bootstrap", "sql_increment", "dim_rollup",
             "enrich_left_join", "merge_insert_rows", "merge_insert_table", "merge_upsert", "expectations",
             "value_constraints", "manifest_topk", "ledger_next_batch", "ledger_current_state",
             "synth_transactions"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def scanned_partitions(df) -> int:
    """Partition folders that the plan's only scan selects (a metric of the scan after it ran)."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.startswith("Scan parquet"):
            found.append(node.metrics().apply("numPartitions").value())
        kids = node.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    qe = df._jdf.queryExecution()
    qe.executedPlan().executeCollect()
    walk(qe.executedPlan())
    assert len(found) == 1
    return found[0]


@pytest.mark.parametrize("name", READ_ONLY)
def test_no_python_in_the_plan(spark, name):
    p = plan(E.queries()[name](spark, SF))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"):
        assert op not in p, f"{name} runs Python rows: {op}"


def test_size_probe_has_no_single_partition_funnel(spark):
    df = spark.range(0, 1000, 1, 8).withColumn("s", F.lit("x"))
    size = measure(df)
    assert size.rows == 1000 and size.bounded
    q = df.agg(F.count(F.lit(1)))  # the probe's shape: partial + final aggregate, no GlobalLimit
    assert "GlobalLimit" not in plan(q)


def test_pipeline_increment_is_pruned_and_pushed(spark, tmp_path):
    t = create_table(spark, Table(str(tmp_path / "raw"), RAW_SCHEMA, ("batch_id", "order_month")))
    rows = spark.range(10).select(
        F.col("id").alias("invoiceid"), F.lit(1).cast("long").alias("itemid"), F.lit(1).cast("long").alias("customerid"),
        F.lit("c").alias("category"), F.lit(1.0).alias("price"), F.lit(1).alias("quantity"),
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("orderdate"),
        F.timestamp_seconds(F.lit(1_700_000_000)).alias("processed_date"), F.lit("CA").alias("state"),
        F.lit("Standard").alias("shippingtype"), F.lit("r").alias("referral"))
    old, new = "20230101T000000000000Z", "20240101T000000000000Z"
    for batch_id in (old, new, "backfill-1"):
        append(t, rows, batch_id=batch_id, cluster="local")
    from tidemark.operators.increment import increment

    inc = increment(read_table(spark, t, keep_hidden=True), 1_600_000_000_000_000, batch_col="batch_id",
                    min_batch=new)
    p = plan(inc)
    assert "PartitionFilters: [" in p and "batch_id" in p and "GreaterThan(processed_date" in p
    # folders whose key is an older stamp are not read; keys that are no stamp are
    assert scanned_partitions(inc) == 2 and inc.count() == 20
    one = read_batch(spark, t, new)
    assert one.count() == 10 and len(one.inputFiles()) >= 1
    assert all(f"batch_id={new}" in f for f in one.inputFiles())


def test_merge_probe_is_map_side_with_key_range(spark, tmp_path):
    spark.range(0, 1000, 1, 4).select(F.col("id").alias("k")).write.parquet(str(tmp_path / "target"))
    target = spark.read.parquet(str(tmp_path / "target"))
    source = spark.range(990, 1010).select(F.col("id").alias("k"))
    out = merge_insert(target, source, "k")
    p = plan(out)
    assert "LeftSemi" in p and "LeftAnti" in p
    assert "GreaterThanOrEqual(k,990)" in p and "LessThanOrEqual(k,1009)" in p
    # the target streams through the probe (source keys are the broadcast build side); the only
    # exchange is the map-side-combined distinct of the matched keys, bounded by the source keys
    assert "LeftSemi, BuildRight" in p
    scan_line = [ln for ln in p.splitlines() if "FileScan parquet" in ln][0]
    assert "ReadSchema: struct<k:bigint>" in scan_line
    assert sorted(r.k for r in out.collect()) == list(range(1000, 1010))
