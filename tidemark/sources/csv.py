"""CSV sources and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """Header + inferred types (an extra pass over the file, fine for dimension-sized input)."""
    return spark.read.option("header", True).option("inferSchema", True).csv(path)


def widen_integers(df: DataFrame) -> DataFrame:
    """Integral columns -> bigint (inference gives INT for values below 2^31)."""
    return df.select(*[
        (F.col(f"`{f.name}`").cast("bigint") if isinstance(f.dataType, T.IntegralType)
         else F.col(f"`{f.name}`")).alias(f.name)
        for f in df.schema.fields
    ])


def read_dimension_csv(spark: SparkSession, path: str) -> DataFrame:
    return widen_integers(read_csv_inferred(spark, path))


def write_csv(df: DataFrame, path: str, order_by: str | None = None) -> None:
    """K5: header CSV; ``order_by`` gives key order (a global sort, meant for dimension-sized frames)."""
    out = df.orderBy(order_by) if order_by else df
    out.write.mode("overwrite").option("header", True).csv(path)
