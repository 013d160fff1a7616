"""Key-based merges on tables without row-level operations.

``merge_insert`` (J2) is ``MERGE INTO t USING s ON t.k = s.k WHEN NOT MATCHED
THEN INSERT *``: every source row whose key has no target row, duplicates
within the source included, NULL keys included (NULL never matches).

``merge_upsert`` (R4) adds ``WHEN MATCHED THEN UPDATE SET *``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.skew import anti_join, hot_keys
from tidemark.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, fits_broadcast, measure


class DuplicateSourceKey(ValueError):
    """Two source rows for one key: an update would be ambiguous."""


def _keys(keys: str | list[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _not_null(keys: list[str]):
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def source_key_size(source: DataFrame, keys: str | list[str], max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                    refuse_duplicates: bool = False):
    """The size probe of the source's non-NULL keys (rows, bytes, min/max of a single key)."""
    keys = _keys(keys)
    single = keys[0] if len(keys) == 1 else None
    src_keys = source.select(*keys).filter(_not_null(keys))
    return measure(src_keys, max_rows, key=single if refuse_duplicates else None, bounds_of=single, hot_keys_of=keys)


def matched_keys(target: DataFrame, source: DataFrame, keys: str | list[str],
                 max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int | None = None,
                 refuse_duplicates: bool = False, size=None) -> DataFrame | None:
    """Distinct keys present in both sides, computed without shuffling the target.

    The source's distinct non-NULL keys are measured; if they are provably
    small they are broadcast and the target's key column is probed map-side
    (``left_semi``, build side = source keys). Returns None when the source
    keys are too large to broadcast.
    """
    keys = _keys(keys)
    if max_bytes is None:
        from tidemark.session import broadcast_threshold

        max_bytes = broadcast_threshold(source.sparkSession) or 50 * 1024 * 1024
    src_keys = source.select(*keys).filter(_not_null(keys))
    # rows bound distinct keys from above: measuring without the distinct saves a shuffle
    single = keys[0] if len(keys) == 1 else None
    if size is None:  # a caller that already probed the source passes ``size``
        size = measure(src_keys, max_rows, key=single if refuse_duplicates else None, bounds_of=single)
    if not fits_broadcast(size, max_bytes):
        if refuse_duplicates:
            check_unique(source, keys)
        return None
    if refuse_duplicates:
        if single is None:
            check_unique(source, keys)
        elif size.duplicate_keys:
            raise DuplicateSourceKey(f"source has repeated keys {keys}")
    if size.rows == 0:
        return target.select(*keys).limit(0)
    probe = target.select(*keys)
    exact_literal = single is not None and isinstance(src_keys.schema[single].dataType,
                                                       (T.IntegralType, T.StringType))
    if exact_literal and size.key_min is not None:
        # a range predicate the parquet reader can use against row-group min/max statistics:
        # with ids that grow over time, old row groups are skipped without being read
        # (integral and string keys only: their literals round-trip exactly)
        probe = probe.filter(F.col(keys[0]).between(F.lit(size.key_min), F.lit(size.key_max)))
    return probe.join(F.broadcast(src_keys.distinct()), keys, "left_semi").distinct()


def first_of_each_key(source: DataFrame, keys: str | list[str], order_by: list[str] | None = None) -> DataFrame:
    """One row per key, the least by ``order_by`` (then by all columns); rows with NULL keys are all kept.

    An aggregate with map-side combination: a key with very many rows costs one row per task.
    """
    keys = _keys(keys)
    whole = [F.col(f"`{c}`") for c in source.columns]
    order = F.struct(*[F.col(f"`{c}`") for c in order_by or []], *whole)
    keyed = source.filter(_not_null(keys))
    kept = (keyed.select(*[F.col(f"`{k}`") for k in keys], F.struct(order.alias("o"), F.struct(*whole).alias("row")).alias("v"))
            .groupBy(*keys).agg(F.min("v").alias("v")).select("v.row.*"))
    return kept.unionByName(source.filter(~_not_null(keys)))


def merge_insert(target: DataFrame, source: DataFrame, keys: str | list[str],
                 max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int | None = None,
                 size=None, dedupe_source: bool = False, dedupe_order: list[str] | None = None) -> DataFrame:
    """Source rows to append (not matched by key). NULL keys are kept.

    Rows of the source that share a key are all kept, as MERGE does, unless
    ``dedupe_source``: then one of each key is, the least by ``dedupe_order``.
    ``size``: the source's key probe (``source_key_size``) if the caller already has it.
    """
    keys = _keys(keys)
    if dedupe_source:
        source = first_of_each_key(source, keys, dedupe_order)
    if size is None:
        size = source_key_size(source, keys, max_rows)
    hit = matched_keys(target, source, keys, max_rows, max_bytes, size=size)
    if hit is not None:
        # hit is a subset of the measured source keys, so its size is bounded too.
        return source.join(F.broadcast(hit), keys, "left_anti")
    # Large increment (e.g. first load): shuffle anti-join; hot keys of the source stay out of the shuffle.
    return anti_join(source, target, keys, size.hot if size.hot is not None else hot_keys(source, keys))


def merge_insert_table(target: DataFrame, source: DataFrame, keys: str | list[str], **kw) -> DataFrame:
    """Content of the target after the insert-only merge."""
    return target.unionByName(merge_insert(target, source, keys, **kw).select(*target.columns))


def check_unique(source: DataFrame, keys: str | list[str]) -> None:
    keys = _keys(keys)
    dup = (source.filter(_not_null(keys)).groupBy(*keys).count()
           .filter(F.col("count") > 1).limit(1).count())
    if dup:
        raise DuplicateSourceKey(f"source has repeated keys {keys}")


def merge_upsert(target: DataFrame, source: DataFrame, keys: str | list[str], verify_unique: bool = True,
                 max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int | None = None) -> DataFrame:
    """Content of the target after update-or-insert by key.

    Target rows whose key appears in the source are replaced by the source
    row; the other target rows are kept; unmatched source rows are inserted.
    """
    keys = _keys(keys)
    # the uniqueness check rides on the size probe when the source is small
    hit = matched_keys(target, source, keys, max_rows, max_bytes, refuse_duplicates=verify_unique)
    right = F.broadcast(hit) if hit is not None else source.select(*keys)
    kept = target.join(right, keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))
