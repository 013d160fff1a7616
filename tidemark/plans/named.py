"""Tables by name in the session catalog (S10, K1, K2, K11): ``namespace.table`` with
``saveAsTable`` and ``spark.table``. Where the files lie is the catalog's business."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.plans.tables import conform, ensure_namespace


def create_named(spark: SparkSession, name: str, schema: T.StructType,
                 partition_by: tuple[str, ...] = ()) -> DataFrame:
    """An empty table, unless it exists; creates the namespace of a qualified name."""
    namespace, dot, _ = name.rpartition(".")
    if dot:
        ensure_namespace(spark, namespace)
    writer = spark.createDataFrame([], schema).write.mode("ignore").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return spark.table(name)


def append_named(spark: SparkSession, name: str, df: DataFrame) -> None:
    """K1: append by column name. Missing or unexpected columns are refused (``SchemaMismatch``)."""
    conform(df, spark.table(name).schema).write.mode("append").saveAsTable(name)


def overwrite_named(spark: SparkSession, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """K2: replace content and schema. A frame that reads the table itself is refused by Spark."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return spark.table(name)
