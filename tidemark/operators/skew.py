"""Joins of two large sides in which a few keys hold very many rows.

A frequent-items sketch (one mergeable aggregate, a few KB per task) finds the keys that hold
more than ``share`` of a side's rows: at most ``1 / share`` of them can exist, at any size.
Rows of these keys never enter the shuffle: what the other side has for them is few distinct
rows, which are broadcast. All other rows are joined by a shuffle in which no key is large.

Keys are compared by value; a 64-bit hash of them only says which way a row takes, so a
collision sends a row the other way and changes no result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.005  # a key above it would fill a shuffle partition of its own at 200 partitions
_TRACKED_PER_HOT = 10  # items the sketch tracks for each that can be hot


def key_hash(keys: list[str]) -> Column:
    """NULL if a key part is NULL: such a row matches nothing and is never hot."""
    h = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    for k in keys:
        h = F.when(F.col(f"`{k}`").isNotNull(), h)
    return h


@dataclass(frozen=True)
class HotKeys:
    """Hashes of the hot keys (at most ``1 / share``)."""

    hashes: tuple[int, ...]

    def __bool__(self) -> bool:
        return bool(self.hashes)

    def rows(self, df: DataFrame, keys: list[str]) -> DataFrame:
        return df.filter(key_hash(keys).isin(list(self.hashes)))

    def others(self, df: DataFrame, keys: list[str]) -> DataFrame:
        """All other rows, those with NULL keys among them."""
        h = key_hash(keys)
        return df.filter(h.isNull() | ~h.isin(list(self.hashes)))


def sketch(keys: list[str], share: float = HOT_SHARE) -> Column:
    """Aggregate: candidates for keys with at least ``share`` of the rows (for ``hot_of``)."""
    most = int(1 / share)
    hashed = ", ".join(f"`{k}`" for k in keys)
    some = " AND ".join(f"`{k}` IS NOT NULL" for k in keys)
    return F.expr(f"approx_top_k(CASE WHEN {some} THEN xxhash64({hashed}) END, {most}, {most * _TRACKED_PER_HOT})")


def hot_of(top: list | None, rows: int, share: float = HOT_SHARE) -> HotKeys:
    return HotKeys(tuple(sorted(t["item"] for t in top or [] if t["item"] is not None and t["count"] >= share * rows)))


def hot_keys(df: DataFrame, keys: list[str], share: float = HOT_SHARE) -> HotKeys:
    """Keys of ``df`` with at least ``share`` of its rows (one scan of the key columns)."""
    row = df.agg(F.count(F.lit(1)).alias("n"), sketch(keys, share).alias("top")).first()
    return hot_of(row["top"], row["n"], share)


def anti_join(source: DataFrame, target: DataFrame, keys: list[str], hot: HotKeys) -> DataFrame:
    """Rows of ``source`` whose key ``target`` has not (NULL keys are kept); ``hot``: keys of the source.

    The target's keys are made distinct in the tasks that read them, before the shuffle that the
    join needs anyway, so a key that the target holds very often is no load either.
    """
    wanted = target.select(*keys)
    cold = hot.others(source, keys) if hot else source
    out = cold.join((hot.others(wanted, keys) if hot else wanted).distinct(), keys, "left_anti")
    if hot:  # distinct keys of a bounded set: at most as many as there are hot hashes
        known = hot.rows(wanted, keys).distinct()
        out = out.unionByName(hot.rows(source, keys).join(F.broadcast(known), keys, "left_anti"))
    return out


def left_join(facts: DataFrame, fact_key: str, right: DataFrame, right_key: str, hot: HotKeys) -> DataFrame:
    """``facts`` left joined with ``right``, whose keys are unique (as they are in a dimension)."""
    def joined(left: DataFrame, other: DataFrame) -> DataFrame:
        return left.join(other, left[fact_key] == other[right_key], "left")

    if not hot:
        return joined(facts, right)
    few = F.broadcast(hot.rows(right, [right_key]))  # unique keys: at most as many rows as hot hashes
    return joined(hot.others(facts, [fact_key]), hot.others(right, [right_key])).unionByName(
        joined(hot.rows(facts, [fact_key]), few))
