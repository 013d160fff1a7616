"""Dimension roll-up (A1, P14, P15): county rows -> one row per state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import DIMENSION_KEY


def rollup_dimension(df: DataFrame, key: str = "State", rename_to: str = DIMENSION_KEY,
                     mean_prefix: str = "Income", how: dict[str, str] | None = None) -> DataFrame:
    """Group by ``key``; integer columns are summed, those starting with
    ``mean_prefix`` are averaged; other columns are ignored. Output: key, sums, means.

    ``how`` overrides the rule per column (``"sum"`` or ``"mean"``). NULL keys
    are dropped. Sum and count are algebraic, so Spark combines map-side and
    a hot key costs one partial row per task.
    """
    how = dict(how or {})
    integral = [f.name for f in df.schema.fields
                if f.name != key and isinstance(f.dataType, T.IntegralType)]
    for c in integral:
        how.setdefault(c, "mean" if c.startswith(mean_prefix) else "sum")
    sums = [c for c in integral if how[c] == "sum"] + [c for c in how if how[c] == "sum" and c not in integral]
    means = [c for c in integral if how[c] == "mean"] + [c for c in how if how[c] == "mean" and c not in integral]
    aggs = [F.sum(F.col(f"`{c}`")).alias(c) for c in sums]  # sum(int) is bigint
    # exact integer sum, one division: equals an unweighted mean of the group
    aggs += [(F.sum(F.col(f"`{c}`")).cast("double") / F.count(F.col(f"`{c}`"))).alias(c) for c in means]
    return (df.filter(F.col(f"`{key}`").isNotNull())
            .groupBy(F.col(f"`{key}`").alias(rename_to))
            .agg(*aggs))
