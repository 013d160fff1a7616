import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.tables import SchemaMismatch, Table, append, create_table, overwrite, read_table, repartition_table

SCHEMA = T.StructType([T.StructField("invoiceid", T.LongType()), T.StructField("orderdate", T.TimestampType()),
                       T.StructField("v", T.StringType())])


def rows(spark, n, start=0):
    return spark.createDataFrame([(start + i, None, f"v{i}") for i in range(n)], SCHEMA) \
        .withColumn("orderdate", F.timestamp_seconds(F.col("invoiceid") * 86400 * 20))


def test_create_read_empty(spark, tmp_path):
    t = create_table(spark, Table(str(tmp_path / "t"), SCHEMA, ("batch_id", "order_month")))
    assert read_table(spark, t).count() == 0
    assert read_table(spark, t).columns == ["invoiceid", "orderdate", "v"]


def test_append_by_name(spark, tmp_path):
    t = create_table(spark, Table(str(tmp_path / "t"), SCHEMA))
    append(t, rows(spark, 3))
    append(t, rows(spark, 2, 10).select("v", "orderdate", "invoiceid"))
    assert sorted(r.invoiceid for r in read_table(spark, t).collect()) == [0, 1, 2, 10, 11]
    with pytest.raises(SchemaMismatch):
        append(t, rows(spark, 1).drop("v"))
    with pytest.raises(SchemaMismatch):
        append(t, rows(spark, 1).withColumn("extra", F.lit(1)))


def test_batch_write_is_replayable(spark, tmp_path):
    t = create_table(spark, Table(str(tmp_path / "t"), SCHEMA, ("batch_id", "order_month")))
    append(t, rows(spark, 5), batch_id="b1")
    append(t, rows(spark, 5), batch_id="b1")  # replay of the same batch
    append(t, rows(spark, 2, 100), batch_id="b2")
    assert read_table(spark, t).count() == 7
    assert read_table(spark, t, batches=["b2"]).count() == 2
    assert read_table(spark, t, exclude_batch="b1").count() == 2


def test_month_pruning(spark, tmp_path):
    t = create_table(spark, Table(str(tmp_path / "t"), SCHEMA, ("order_month",)))
    append(t, rows(spark, 10))
    df = read_table(spark, t, months=(0, 0))
    assert "PartitionFilters: [isnotnull(order_month" in df._jdf.queryExecution().executedPlan().toString() \
        or df.inputFiles()
    assert df.count() == 2  # days 0 and 20 of 1970-01


def test_overwrite_self_read_is_staged(spark, tmp_path):
    t = create_table(spark, Table(str(tmp_path / "t"), SCHEMA))
    append(t, rows(spark, 4))
    t2 = overwrite(spark, t, read_table(spark, t).filter("invoiceid < 2"))
    assert sorted(r.invoiceid for r in read_table(spark, t2).collect()) == [0, 1]
    other = spark.createDataFrame([(1, "x")], "k int, s string")
    t3 = overwrite(spark, t2, other)
    assert read_table(spark, t3).collect()[0].s == "x"


def test_repartition_table(spark, tmp_path):
    t = create_table(spark, Table(str(tmp_path / "t"), SCHEMA, ("batch_id", "order_month")))
    append(t, rows(spark, 6), batch_id="b1")
    append(t, rows(spark, 6, 50), batch_id="b2")
    moved = repartition_table(spark, t, str(tmp_path / "m"))
    assert moved.partition_by == ("order_month",)
    assert sorted(r.invoiceid for r in read_table(spark, moved).collect()) == sorted(
        r.invoiceid for r in read_table(spark, t).collect())


def test_upsert_table_rewrites_only_touched_months(spark, tmp_path):
    from tidemark.plans.tables import upsert_table

    t = create_table(spark, Table(str(tmp_path / "t"), SCHEMA, ("order_month",)))
    append(t, rows(spark, 10))  # invoice i on day 20*i -> months 0..5
    src = spark.createDataFrame([(0, None, "new0"), (1, None, "new1"), (99, None, "ins")], SCHEMA) \
        .withColumn("orderdate", F.timestamp_seconds(F.col("invoiceid") * 86400 * 20))
    import os

    def files(months):
        return {(m, f) for m in months for f in os.listdir(f"{t.path}/order_month={m}")}

    before = files(range(2, 6))
    upsert_table(spark, t, src, "invoiceid")
    got = {r.invoiceid: r.v for r in read_table(spark, t).collect()}
    assert got == {**{i: f"v{i}" for i in range(10)}, 0: "new0", 1: "new1", 99: "ins"}
    assert files(range(2, 6)) == before  # months without matched or new rows were not rewritten
    upsert_table(spark, t, src, "invoiceid")  # again: same table
    assert read_table(spark, t).count() == 11


def test_upsert_table_batch_level_empties_old_folder(spark, tmp_path):
    from tidemark.plans.tables import upsert_table

    t = create_table(spark, Table(str(tmp_path / "t"), SCHEMA, ("batch_id", "order_month")))
    append(t, rows(spark, 2), batch_id="b1")  # both rows in month 0 of b1
    src = rows(spark, 2).withColumn("v", F.lit("upd"))
    upsert_table(spark, t, src, "invoiceid")
    out = read_table(spark, t, keep_hidden=True).collect()
    assert sorted((r.invoiceid, r.v) for r in out) == [(0, "upd"), (1, "upd")]
    assert all(r.batch_id != "b1" for r in out)


def test_upsert_table_unpartitioned(spark, tmp_path):
    from tidemark.plans.tables import upsert_table

    t = create_table(spark, Table(str(tmp_path / "flat"), SCHEMA))
    append(t, rows(spark, 4))
    src = rows(spark, 2, 3).withColumn("v", F.lit("new"))  # invoice 3 updated, 4 inserted
    upsert_table(spark, t, src, "invoiceid")
    got = {r.invoiceid: r.v for r in read_table(spark, t).collect()}
    assert got == {0: "v0", 1: "v1", 2: "v2", 3: "new", 4: "new"}
