from pyspark.sql import functions as F

from tidemark.functions.columns import (derive_check_columns, epoch_to_timestamp_ntz, month_index, path_basename,
                                        strip_scheme)
from tidemark.schemas import US_STATES
from tidemark.sources.synth import synth_range


def test_synth_ranges_unique_and_stable(spark):
    a = synth_range(spark, 1000, partitions=3)
    b = synth_range(spark, 1000, partitions=7)
    assert sorted(a.collect()) == sorted(b.collect())
    s = a.agg(F.countDistinct("invoiceid"), F.countDistinct("itemid"), F.countDistinct("customerid"),
              F.min("price"), F.max("price"), F.min("quantity"), F.max("quantity"),
              F.min(F.year(F.timestamp_seconds("orderdate"))), F.max(F.year(F.timestamp_seconds("orderdate")))).first()
    assert s[0] == 1000 and s[1] == 1000 and s[2] == 1000
    assert 10 <= s[3] and s[4] <= 100 and s[5] >= 1 and s[6] <= 5 and s[7] >= 2020 and s[8] <= 2025
    assert {r.state for r in a.select("state").distinct().collect()} <= set(US_STATES)


def test_date_parts(spark):
    df = spark.createDataFrame([(0,), (1700000000,), (None,)], "orderdate long")
    r = derive_check_columns(df).collect()
    assert (r[0].orderdate, r[0].orderdate_date, r[0].orderdate_time, r[0].orderdate_year) == \
        ("1970-01-01 00:00:00", "1970-01-01", "00:00:00", 1970)
    assert r[1].orderdate_date == "2023-11-14" and r[1].orderdate_time == "22:13:20"
    assert r[2].orderdate is None and r[2].orderdate_year is None


def test_month_index_and_paths(spark):
    df = spark.createDataFrame([(0,), (86400 * 31,), (None,)], "e long").select(epoch_to_timestamp_ntz("e").alias("t"))
    assert [r[0] for r in df.select(month_index("t")).collect()] == [0, 1, None]
    p = spark.createDataFrame([("s3a://bucket/raw/t1.parquet",)], "p string")
    r = p.select(strip_scheme("p"), path_basename("p")).first()
    assert tuple(r) == ("bucket/raw/t1.parquet", "t1.parquet")


def test_manifest_lines_and_bound(spark, tmp_path):
    import pytest

    from tidemark.sources.files import manifest_paths, read_manifest

    m = tmp_path / "manifest.pending"
    m.write_text("s3a://b/raw/t1.parquet\n\n  s3a://b/raw/t2.parquet  \n   \n")
    got = manifest_paths(read_manifest(spark, str(m)), 5)
    assert sorted(got) == ["s3a://b/raw/t1.parquet", "s3a://b/raw/t2.parquet"]
    with pytest.raises(ValueError):
        manifest_paths(read_manifest(spark, str(m)), 1)


def test_namespace_and_listing(spark, tmp_path):
    from tidemark.plans.tables import ensure_namespace
    from tidemark.sources.files import list_files

    ensure_namespace(spark, "tidemark_test_db")
    assert "tidemark_test_db" in [d.name for d in spark.catalog.listDatabases()]
    assert list_files(spark, str(tmp_path / "missing")).count() == 0
    spark.range(3).write.parquet(str(tmp_path / "a" / "x"))
    listing = list_files(spark, str(tmp_path / "a"))
    assert listing.columns == ["path", "length", "modificationTime", "version"]
    assert listing.count() >= 1
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_layout_helpers_and_landing_writer(spark, tmp_path):
    from tidemark.operators.layout import cluster_for_write, hash_cluster, preview, with_month
    from tidemark.sources.files import list_files, read_landing, read_manifest, write_manifest
    from tidemark.sources.synth import write_landing_files

    df = synth_range(spark, 200)
    write_landing_files(df, str(tmp_path / "landing"), 4)
    listing = list_files(spark, str(tmp_path / "landing"))
    assert listing.count() == 4
    write_manifest(listing, str(tmp_path / "manifest"))
    paths = [r.path for r in read_manifest(spark, str(tmp_path / "manifest")).collect()]
    assert read_landing(spark, paths).count() == 200
    ts = df.withColumn("orderdate", F.timestamp_seconds("orderdate"))
    h = hash_cluster(ts, 4, "orderdate")
    assert h.rdd.getNumPartitions() == 4 and h.count() == 200
    r = cluster_for_write(with_month(ts), num_partitions=3)
    assert r.rdd.getNumPartitions() == 3
    # range partitioning keeps months contiguous: each month lives in at most two adjacent tasks
    spans = r.select("order_month", F.spark_partition_id().alias("p")).groupBy("order_month") \
        .agg((F.max("p") - F.min("p")).alias("span")).agg(F.max("span")).first()[0]
    assert spans <= 1
    assert preview(df, 5).count() == 5


def test_range_clustering_splits_a_hot_instant(spark):
    from tidemark.operators.layout import cluster_for_write, with_month

    hot = spark.range(0, 3000).select(F.col("id").alias("k"), F.timestamp_seconds(F.lit(0)).alias("orderdate"))
    cold = spark.range(3000, 6000).select(F.col("id").alias("k"), F.timestamp_seconds(F.col("id") * 86400).alias("orderdate"))
    out = cluster_for_write(with_month(hot.unionByName(cold)), num_partitions=6)
    sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 3000  # the 3000 rows with one identical instant are not in one task
    assert sum(sizes) == 6000
