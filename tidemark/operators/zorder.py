"""Clustering by several columns at once (O2, O5): range partitioning on a bit-interleaved key.

Sorting by (month, key) lets only the month skip files. On the Z-order curve rows that are
near in every column are near in the file, so a predicate on any one of the columns skips
row groups. Each column is first cut into ``2 ** bits`` ranges of about equal row counts
(approximate quantiles, one aggregate), so skewed values do not waste bits.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BITS = 6
_ACCURACY = 2000


def _number(df: DataFrame, name: str) -> Column:
    kind, c = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp").cast("double")
    raise ValueError(f"column {name!r} has no order that maps to numbers: {kind.simpleString()}")


def range_bounds(df: DataFrame, columns: list[str], bits: int = DEFAULT_BITS) -> dict[str, list[float]]:
    """At most ``2 ** bits - 1`` inner bounds per column."""
    n = 1 << bits
    at = [i / n for i in range(1, n)]
    row = df.agg(*[F.percentile_approx(_number(df, c), at, _ACCURACY).alias(f"b{i}") for i, c in enumerate(columns)]).first()
    return {c: sorted(set(row[i] or [])) for i, c in enumerate(columns)}


def _range_of(value: Column, bounds: list[float]) -> Column:
    """How many bounds are at most the value; NULL is in the first range."""
    if not bounds:
        return F.lit(0).cast("long")
    below = F.aggregate(F.array(*[F.lit(b) for b in bounds]), F.lit(0).cast("long"),
                        lambda n, b: n + (b <= value).cast("long"))
    return F.when(value.isNull(), F.lit(0).cast("long")).otherwise(below)


def interleave(parts: list[Column], bits: int) -> Column:
    """Bit ``i`` of part ``j`` becomes bit ``i * len(parts) + len(parts) - 1 - j``: the first part leads."""
    if bits * len(parts) > 62:
        raise ValueError("more than 62 bits")
    out = F.lit(0).cast("long")
    for i in range(bits):
        for j, p in enumerate(parts):
            bit = F.shiftright(p, i).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(bit, i * len(parts) + len(parts) - 1 - j))
    return out


def zorder_key(df: DataFrame, columns: list[str], bits: int = DEFAULT_BITS,
               bounds: dict[str, list[float]] | None = None) -> Column:
    bounds = bounds or range_bounds(df, columns, bits)
    return interleave([_range_of(_number(df, c), bounds[c]) for c in columns], bits)


def cluster_zorder(df: DataFrame, columns: list[str], bits: int = DEFAULT_BITS, files: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted along the Z-order curve of ``columns``.

    Equal places on the curve are split by a hash of the row, so a value that holds a third of
    all rows still spreads over tasks. NULLs count as the least value.
    """
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    placed = df.withColumn("__z", zorder_key(df, columns, bits)).withColumn("__tie", tie)
    by = ["__z", "__tie"]
    dealt = placed.repartitionByRange(files, *by) if files else placed.repartitionByRange(*by)
    return dealt.sortWithinPartitions("__z").drop(*by)


def place_of(values: dict[str, float], bounds: dict[str, list[float]]) -> dict[str, int]:
    """Range number of plain values (for tests and planning)."""
    return {c: bisect_right(bounds[c], v) for c, v in values.items()}
