"""Drift of a batch against the batches before it (Q5, Q6).

Each batch leaves one profile row per column: counts, bounds, a quantile sketch (KLL) and a
distinct sketch (HLL), a few KB whatever the batch's size. Sketches merge, so the history of
any number of batches is one aggregate over their profiles; no earlier batch is read again.

Two distributions are compared by rank distance: the largest difference, over the values of a
grid of quantiles of both sides, between the share of rows up to that value on one side and
on the other (the Kolmogorov-Smirnov distance). The sketch of ``SKETCH_K`` knows a rank to
about 0.4 % and the grid steps by ``1 / STEPS``, so a distance is known to about 2 %.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCH_K = 800
STEPS = 100
DEFAULT_MAX_DISTANCE = 0.1
PROFILE_SCHEMA = T.StructType([
    T.StructField("batch_id", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("nulls", T.LongType()),
    T.StructField("least", T.DoubleType()),
    T.StructField("greatest", T.DoubleType()),
    T.StructField("quantiles", T.BinaryType()),
    T.StructField("distinct", T.BinaryType()),
])


def profile(batch: DataFrame, columns: list[str], batch_id: str | Column) -> DataFrame:
    """One row per column (``PROFILE_SCHEMA``), from one aggregate over one scan.

    Columns are numeric; NULLs and NaNs are counted as NULLs and not sketched. A column
    without values has no quantile sketch. ``batch_id`` may be a column: then the frame holds
    many batches, and each gets its rows.
    """
    by = [batch_id.alias("batch_id")] if isinstance(batch_id, Column) else []
    values = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in columns}
    rows = batch.select(*by, *[v.alias(f"v{i}") for i, v in enumerate(values.values())])
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(columns)):
        v = F.col(f"v{i}")
        aggs += [F.count(v).alias(f"n{i}"), F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"),
                 F.kll_sketch_agg_double(v, F.lit(SKETCH_K)).alias(f"q{i}"), F.hll_sketch_agg(F.xxhash64(v)).alias(f"d{i}")]
    one = rows.groupBy(*["batch_id"] if by else []).agg(*aggs)
    if not by:
        one = one.withColumn("batch_id", F.lit(batch_id))
    structs = [F.struct(
        "batch_id", F.lit(c).alias("column_name"), "rows", (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
        F.col(f"lo{i}").alias("least"), F.col(f"hi{i}").alias("greatest"),
        F.when(F.col(f"n{i}") > 0, F.col(f"q{i}")).alias("quantiles"), F.col(f"d{i}").alias("distinct"))
        for i, c in enumerate(columns)]
    return one.select(F.inline(F.array(*structs)))


def write_profile(profiles: DataFrame, path: str, batch_id: str) -> None:
    """One folder per batch; a replayed batch replaces its own."""
    profiles.drop("batch_id").coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PROFILE_SCHEMA).parquet(path)


def merged(profiles: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Profiles of many batches as one per column (per ``by`` and column)."""
    keys = [*(by or []), "column_name"]
    return profiles.groupBy(*keys).agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"), F.min("least").alias("least"),
        F.max("greatest").alias("greatest"), F.kll_merge_agg_double("quantiles", F.lit(SKETCH_K)).alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.count("quantiles").alias("sketched"))


def distance(a: Column, b: Column) -> Column:
    """Rank distance of two quantile sketches; NULL if one side is empty."""
    ranks = F.array(*[F.lit((i + 0.5) / STEPS) for i in range(STEPS)])
    qa, qb = F.kll_sketch_get_quantile_double(a, ranks), F.kll_sketch_get_quantile_double(b, ranks)

    def share(values: Column, upto: Column) -> Column:
        return F.size(F.filter(values, lambda x: x <= upto)) / F.lit(STEPS)

    # both sides are ranked at the same value, so repeated values are no gap
    gaps = F.transform(F.concat(qa, qb), lambda v: F.abs(share(qa, v) - share(qb, v)))
    return F.when(a.isNotNull() & b.isNotNull(), F.array_max(gaps))


def drift(current: DataFrame, history: DataFrame, max_distance: float = DEFAULT_MAX_DISTANCE) -> DataFrame:
    """Each row of ``current`` (profiles) against the merged profiles of all batches whose id sorts before.

    Columns: batch_id, column_name, rows, nulls, distinct_values (estimate), before_rows,
    ``distance`` (NULL without values on either side) and ``drifted`` (false if NULL).
    """
    now = current.select("batch_id", "column_name", "rows", "nulls", "quantiles",
                         F.hll_sketch_estimate("distinct").alias("distinct_values"))
    # profiles are few KB a batch and column: the pairs of a batch and its predecessors are joined by column
    earlier = history.select(F.col("batch_id").alias("earlier"), "column_name", F.col("rows").alias("r"),
                             F.col("quantiles").alias("q"))
    pairs = now.select("batch_id", "column_name").join(earlier, "column_name").filter("earlier < batch_id")
    past = pairs.groupBy("batch_id", "column_name").agg(
        F.sum("r").alias("before_rows"), F.count("q").alias("sketched"),
        F.kll_merge_agg_double("q", F.lit(SKETCH_K)).alias("before"))
    out = now.join(past, ["batch_id", "column_name"], "left")
    out = out.withColumn("distance", distance(F.col("quantiles"), F.when(F.col("sketched") > 0, F.col("before"))))
    return out.select("batch_id", "column_name", "rows", "nulls", "distinct_values",
                      F.coalesce("before_rows", F.lit(0)).alias("before_rows"), "distance",
                      F.coalesce(F.col("distance") > max_distance, F.lit(False)).alias("drifted"))
