"""Write layout (O1, O2, O5): month column and clustering before a partitioned write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import month_index

MONTH_COL = "order_month"


def with_month(df: DataFrame, ts_col: str = "orderdate", month_col: str = MONTH_COL) -> DataFrame:
    """Hidden partition column ``months(ts)``; NULL instants fall in the NULL partition."""
    return df.withColumn(month_col, month_index(ts_col))


def cluster_for_write(df: DataFrame, month_col: str = MONTH_COL, ts_col: str | None = "orderdate",
                      num_partitions: int | None = None) -> DataFrame:
    """Range-partition by (month, ts) and sort each task's rows.

    Range (not hash) partitioning splits a hot month over several tasks by
    sampling, so one month holding a third of the rows does not become one
    task; each task still writes few month folders. Without
    ``num_partitions`` AQE sizes the partitions from the data.
    """
    order = [month_col] + ([ts_col] if ts_col else [])
    # a deterministic row hash as last range key: even a third of the rows sharing one
    # (month, instant) is cut into several tasks by the sampled bounds (rand() would
    # make a retried task place rows differently)
    split = order + [F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])]
    parts = df.repartitionByRange(num_partitions, *split) if num_partitions else df.repartitionByRange(*split)
    return parts.sortWithinPartitions(*order)


def hash_cluster(df: DataFrame, n: int, *cols: str) -> DataFrame:
    """O1 as written originally: hash by column(s) into ``n`` partitions, sorted within."""
    return df.repartition(n, *cols).sortWithinPartitions(*cols)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """Opt-in peek (``limit``); executes the frame again when collected."""
    return df.limit(n)


