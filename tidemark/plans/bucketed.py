"""Bucketed tables by name: merges by key that never shuffle the target.

The table is bucketed by a hash of its key. A source is dealt to the same number of
partitions by the same hash, so each task joins one bucket with its share of the source, and
the target is read without an exchange.

A changed table is written beside the old one and takes its place by one catalog change
(``ALTER TABLE ... SET LOCATION``): before it readers see the old content, after it the new
one. A crash before it leaves the table as it was; the half-written files lie in the scratch
folder. Files of the old place are left for readers that still scan them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import _keys, check_unique
from tidemark.plans.tables import conform, ensure_namespace
from tidemark.session import scratch_path


def _write(df: DataFrame, name: str, keys: list[str], buckets: int, location: str) -> None:
    (df.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", location).saveAsTable(name))


def create_bucketed(spark: SparkSession, name: str, df: DataFrame, keys: str | list[str], buckets: int,
                    location: str | None = None) -> DataFrame:
    """``df`` as a new table of ``buckets`` buckets of ``keys``, one file each."""
    keys = _keys(keys)
    namespace, dot, _ = name.rpartition(".")
    if dot:
        ensure_namespace(spark, namespace)
    _write(df.repartition(buckets, *keys), name, keys, buckets, location or scratch_path(spark, "bucketed"))
    return spark.table(name)


def bucket_spec(spark: SparkSession, name: str) -> tuple[list[str], int]:
    """Bucket columns and number of a table."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    if "Num Buckets" not in rows:
        raise ValueError(f"{name} is not bucketed")
    return [c.strip("` ") for c in rows["Bucket Columns"].strip("[]").split(",")], int(rows["Num Buckets"])


def swap_location(spark: SparkSession, name: str, new: str) -> None:
    """Points table ``name`` to the files of table ``new`` (same columns and buckets); forgets ``new``."""
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {new}").collect()}
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{rows['Location']}'")
    spark.catalog.refreshTable(name)
    spark.sql(f"DROP TABLE {new}")  # an external table: its files stay


def _rewrite(spark: SparkSession, name: str, content: DataFrame, keys: list[str], buckets: int) -> None:
    new = f"{name}__next"
    spark.sql(f"DROP TABLE IF EXISTS {new}")  # left by a run that died before its swap
    _write(content.select(*spark.table(name).columns), new, keys, buckets, scratch_path(spark, "bucketed"))
    swap_location(spark, name, new)


@contextmanager
def _bucketed_scans(spark: SparkSession) -> Iterator[None]:
    """Scans by bucket also where no join asks for it; the session's setting is restored."""
    setting = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def unmatched(spark: SparkSession, name: str, source: DataFrame) -> DataFrame:
    """Rows of ``source`` whose key the table has not; rows with NULL keys are kept."""
    keys, buckets = bucket_spec(spark, name)
    return source.repartition(buckets, *keys).join(spark.table(name).select(*keys), keys, "left_anti")


def upserted(spark: SparkSession, name: str, source: DataFrame) -> DataFrame:
    """The table's content with the rows of ``source`` in place of those of equal key."""
    keys, buckets = bucket_spec(spark, name)
    target = spark.table(name)
    dealt = conform(source, target.schema).repartition(buckets, *keys)
    return target.join(dealt.select(*keys), keys, "left_anti").unionByName(dealt.select(*target.columns))


def merge_insert_bucketed(spark: SparkSession, name: str, source: DataFrame) -> None:
    """J2 on a bucketed table: appends what is not there yet (files of the same buckets)."""
    new = unmatched(spark, name, conform(source, spark.table(name).schema))
    new.select(*spark.table(name).columns).write.insertInto(name)


def upsert_bucketed(spark: SparkSession, name: str, source: DataFrame, verify_unique: bool = True) -> None:
    """R4 on a bucketed table: rewritten beside itself, then swapped in."""
    keys, buckets = bucket_spec(spark, name)
    if verify_unique:
        check_unique(source, keys)
    _rewrite(spark, name, upserted(spark, name, source), keys, buckets)


def compact_bucketed(spark: SparkSession, name: str) -> None:
    """One file per bucket again, after many inserts; swapped in like an upsert."""
    keys, buckets = bucket_spec(spark, name)
    with _bucketed_scans(spark):  # one partition per bucket: nothing is shuffled
        _rewrite(spark, name, spark.table(name), keys, buckets)


def files_per_bucket(spark: SparkSession, name: str) -> DataFrame:
    """(bucket, files, rows) of a bucketed table, by the bucket number in the file names."""
    file = F.input_file_name()
    return (spark.table(name).select(F.regexp_extract(file, r"_([0-9]{5})(?:\.c[0-9]+)?[^/]*$", 1).cast("int").alias("bucket"),
                                     file.alias("file"))
            .groupBy("bucket").agg(F.count_distinct("file").alias("files"), F.count("*").alias("rows")))
