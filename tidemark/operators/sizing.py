"""Size checks that guard every broadcast.

A side is broadcast only after a job measured it: row count and byte size
(fixed widths plus the actual length of every string) come from one
aggregate with map-side partial aggregation, so each task ships one row and
nothing is funnelled through a single task (a ``limit`` before the aggregate
would gather up to ``max_rows`` rows per task into one partition).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.skew import HotKeys, hot_of, sketch

DEFAULT_MAX_BROADCAST_ROWS = 2_000_000


@dataclass(frozen=True)
class SideSize:
    rows: int
    bytes: int
    bounded: bool  # rows <= max_rows
    duplicate_keys: bool = False  # only computed when a key is given
    key_min: object = None  # only computed when bounds_of is given
    key_max: object = None
    hot: HotKeys | None = None  # only computed when hot_keys_of is given


def _width(field: T.StructField) -> Column | int:
    dt = field.dataType
    name = F.col(f"`{field.name}`")
    if isinstance(dt, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(name), F.lit(0)) + 8
    if isinstance(dt, (T.ByteType, T.BooleanType)):
        return 1
    if isinstance(dt, T.ShortType):
        return 2
    if isinstance(dt, (T.IntegerType, T.FloatType, T.DateType)):
        return 4
    if isinstance(dt, T.DecimalType):
        return 16
    if isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(name)), F.lit(0)) + 16
    return 8


def measure(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, key: str | None = None,
            bounds_of: str | None = None, hot_keys_of: list[str] | None = None) -> SideSize:
    """Rows and approximate in-memory bytes of ``df`` (one distributed aggregate).

    With ``key``, the same job also tells whether a non-NULL key repeats;
    with ``bounds_of``, it returns that column's min and max, with ``hot_keys_of`` the
    hot keys of these columns.
    """
    widths = [_width(f) for f in df.schema.fields]
    fixed = sum(w for w in widths if isinstance(w, int)) + 16
    var = [w for w in widths if not isinstance(w, int)]
    row_bytes = F.lit(fixed)
    for w in var:
        row_bytes = row_bytes + w
    aggs = [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(row_bytes), F.lit(0)).cast("long").alias("bytes")]
    if key is not None:
        k = F.col(f"`{key}`")
        aggs.append((F.count(k) > F.count_distinct(k)).alias("dup"))
    if bounds_of is not None:
        b = F.col(f"`{bounds_of}`")
        aggs += [F.min(b).alias("lo"), F.max(b).alias("hi")]
    if hot_keys_of is not None:
        aggs.append(sketch(hot_keys_of).alias("top"))
    probe = df.agg(*aggs).first()
    rows, size = int(probe["rows"]), int(probe["bytes"])
    dup = bool(probe["dup"]) if key is not None else False
    lo, hi = (probe["lo"], probe["hi"]) if bounds_of is not None else (None, None)
    return SideSize(rows=rows, bytes=size, bounded=rows <= max_rows, duplicate_keys=dup, key_min=lo, key_max=hi,
                    hot=hot_of(probe["top"], rows) if hot_keys_of is not None else None)


def fits_broadcast(size: SideSize, max_bytes: int) -> bool:
    return size.bounded and max_bytes > 0 and size.bytes <= max_bytes
