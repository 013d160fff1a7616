"""Incremental dimension roll-up (A1): stored partial sums, changed by deltas.

The state holds, per key, how many rows there are and, per measure, their sum and count. Sums
and counts can be added and taken back, so a change of the county rows costs an aggregate of
the changed rows alone: rows that come count +1, rows that go count -1, a corrected row is
one of each. A key whose last row goes leaves the state. All sums are of integers, so the
result equals a full recomputation exactly, in any order of the changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import DIMENSION_KEY
from tidemark.sources.fs import child_dirs

SIGN = "__sign"


def signed(df: DataFrame, sign: int) -> DataFrame:
    """``df`` as rows that come (+1) or go (-1)."""
    return df.withColumn(SIGN, F.lit(sign))


def corrections(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows replaced by others: the old ones go, the new ones come."""
    return signed(old, -1).unionByName(signed(new, 1))


def measures(df: DataFrame, key: str) -> list[str]:
    """Integer columns other than the key (as the full roll-up takes them)."""
    return [f.name for f in df.schema.fields if f.name not in (key, SIGN) and isinstance(f.dataType, T.IntegralType)]


def partial_state(changes: DataFrame, key: str = "State") -> DataFrame:
    """Partial state of signed rows: ``key``, ``rows`` and ``sums``, ``counts`` of every measure.

    NULL keys are dropped. Map-side combined: a hot key costs one row per task.
    """
    cols = measures(changes, key)
    s = F.col(SIGN).cast("long")
    aggs = [F.sum(s).alias("rows")]
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`")
        aggs += [F.sum(F.when(v.isNotNull(), v.cast("long") * s)).alias(f"s{i}"),
                 F.sum(F.when(v.isNotNull(), s).otherwise(F.lit(0).cast("long"))).alias(f"c{i}")]
    grouped = changes.filter(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("key")).agg(*aggs)
    return grouped.select("key", "rows",
                          *[F.struct(F.coalesce(f"s{i}", F.lit(0).cast("long")).alias("sum"), F.col(f"c{i}").alias("count")).alias(c)
                            for i, c in enumerate(cols)])


def combined(*states: DataFrame) -> DataFrame:
    """States of disjoint sets of changes as one; keys without rows left are dropped."""
    cols = [c for c in states[0].columns if c not in ("key", "rows")]
    whole = states[0]
    for s in states[1:]:
        whole = whole.unionByName(s)
    sums = whole.groupBy("key").agg(
        F.sum("rows").alias("rows"),
        *[F.struct(F.sum(f"`{c}`.sum").alias("sum"), F.sum(f"`{c}`.count").alias("count")).alias(c) for c in cols])
    return sums.filter("rows <> 0")


def rollup_of(state: DataFrame, rename_to: str = DIMENSION_KEY, mean_prefix: str = "Income",
              how: dict[str, str] | None = None) -> DataFrame:
    """The dimension that a full roll-up of the rows would give: sums first, then means."""
    cols = [c for c in state.columns if c not in ("key", "rows")]
    rule = {c: (how or {}).get(c, "mean" if c.startswith(mean_prefix) else "sum") for c in cols}
    some = {c: F.col(f"`{c}`.count") != 0 for c in cols}
    return state.select(
        F.col("key").alias(rename_to),
        *[F.when(some[c], F.col(f"`{c}`.sum")).alias(c) for c in cols if rule[c] == "sum"],
        *[F.when(some[c], F.col(f"`{c}`.sum").cast("double") / F.col(f"`{c}`.count")).alias(c) for c in cols if rule[c] == "mean"])


def _versions(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removeprefix("version=")) for n, committed in child_dirs(spark, path)
                  if committed and n.startswith("version="))


def read_state(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest committed version, or None."""
    found = _versions(spark, path)
    return spark.read.parquet(f"{path}/version={found[-1]}") if found else None


def advance(spark: SparkSession, path: str, changes: DataFrame, version: int, key: str = "State") -> DataFrame:
    """Applies signed ``changes`` as ``version`` and returns the new state.

    Versions are the caller's, and grow. A version that was committed is not applied again,
    so a retried delta is harmless; a version whose write was interrupted is written anew.
    """
    found = _versions(spark, path)
    if found and version <= found[-1]:
        return read_state(spark, path)
    delta = partial_state(changes, key)
    old = read_state(spark, path)
    new = combined(delta) if old is None else combined(old, delta)
    new.write.mode("overwrite").parquet(f"{path}/version={version}")
    return spark.read.parquet(f"{path}/version={version}")
