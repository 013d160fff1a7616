"""High-water-mark increment.

``raw.processed_date > COALESCE((SELECT MAX(processed_date) FROM target), '1990-01-01 00:00:00')``

The MAX is resolved first (a one-row aggregate over one pruned column), then
the increment filter uses a literal, so parquet receives a pushed
``GreaterThan`` and skips row groups; a redundant partition predicate on the
batch column (when present) prunes whole directories.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import micros_to_timestamp, timestamp_to_micros
from tidemark.schemas import BOOTSTRAP_WATERMARK


STAMP_KEY = r"^[0-9]{8}T[0-9]{12}Z$"  # batch keys that sort like their stamp


def high_water_mark(target: DataFrame, col: str = "processed_date") -> int | None:
    """MAX(col) of ``target`` as epoch microseconds, or None for an empty target."""
    dtype = target.schema[col].dataType
    row = target.agg(timestamp_to_micros(F.max(col), dtype).alias("hwm")).first()
    return None if row is None or row["hwm"] is None else int(row["hwm"])


def watermark_literal(micros: int | None, dtype, bootstrap: str = BOOTSTRAP_WATERMARK) -> Column:
    """COALESCE(max, bootstrap) as a typed literal of the column's type."""
    if micros is None:
        return F.lit(bootstrap).cast(dtype)
    return micros_to_timestamp(micros, dtype)


def increment(raw: DataFrame, watermark_us: int | None, col: str = "processed_date",
              bootstrap: str = BOOTSTRAP_WATERMARK,
              batch_col: str | None = None, min_batch: str | None = None) -> DataFrame:
    """Rows strictly above the mark; NULL stamps are never selected.

    ``batch_col``/``min_batch``: when the table is partitioned by a batch key,
    folders whose key is a stamp (``STAMP_KEY``) below ``min_batch`` are not even
    listed. A NULL key or one that is no stamp is always read, so no qualifying row
    is removed.
    """
    dtype = raw.schema[col].dataType
    out = raw.filter(F.col(col) > watermark_literal(watermark_us, dtype, bootstrap))
    if batch_col is not None and min_batch is not None:
        key = F.col(batch_col)
        out = out.filter(key.isNull() | ~key.rlike(STAMP_KEY) | (key >= F.lit(min_batch)))
    return out


def increment_from(raw: DataFrame, target: DataFrame, col: str = "processed_date",
                   bootstrap: str = BOOTSTRAP_WATERMARK) -> DataFrame:
    """F1 in one call: mark from ``target`` (whole table), filter ``raw``."""
    return increment(raw, high_water_mark(target, col), col, bootstrap)


def increment_subquery(raw: DataFrame, target: DataFrame, col: str = "processed_date",
                       bootstrap: str = BOOTSTRAP_WATERMARK) -> DataFrame:
    """The literal SQL shape (uncorrelated scalar subquery, F2); no driver round trip."""
    dtype = raw.schema[col].dataType
    mark = F.coalesce(target.select(F.max(col)).scalar(), F.lit(bootstrap).cast(dtype))
    return raw.filter(F.col(col) > mark)
