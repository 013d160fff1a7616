"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A document's shard depends on its key and the number of shards only. There is no ring
table to keep, and going from ``n`` to ``n + 1`` shards moves about ``1 / (n + 1)`` of
the keys, all of them into the new shard.

Everything is DataFrame functions. The 64-bit linear congruential step of the method
needs wrap-around multiplication, which SQL integers refuse to do, so the state is kept
as two 32-bit halves.

Positions inside a shard (``slot``) follow (shard, key, checksum, size) order. They come
from one range-partitioned sort of narrow rows, staged, plus the row counts per
partition; no shard is ever gathered in one task, and rows that share one key are
spread by a row number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

# Fixed value: the multiplier of the published generator, as 32-bit halves.
MULTIPLIER = 2862933555777941757
_MH, _ML = MULTIPLIER >> 32, MULTIPLIER & 0xFFFFFFFF
_LOW32, _LOW16 = 0xFFFFFFFF, 0xFFFF
_QUICK_STEPS = 64


def _times_low32(x: Column, c: int) -> Column:
    """(x * c) mod 2**32 for 32-bit x and c, without leaving 63 bits."""
    low, high = c & _LOW16, c >> 16
    part = x * F.lit(low) + F.shiftleft((x * F.lit(high)).bitwiseAND(F.lit(_LOW16)), 16)
    return part.bitwiseAND(F.lit(_LOW32))


def _next_state(h: Column, l: Column) -> tuple[Column, Column]:
    """Halves of (key * MULTIPLIER + 1) mod 2**64."""
    mid = l * F.lit(_ML >> 16)
    low = l * F.lit(_ML & _LOW16) + F.shiftleft(mid.bitwiseAND(F.lit(_LOW16)), 16) + F.lit(1)
    carry = F.shiftright(low, 32) + F.shiftright(mid, 16)
    high = (_times_low32(h, _ML) + _times_low32(l, _MH) + carry).bitwiseAND(F.lit(_LOW32))
    return high, low.bitwiseAND(F.lit(_LOW32))


def jump_hash(key: Column, shards: int) -> Column:
    """Shard of a 64-bit integer key, 0 to ``shards - 1``.

    A NULL key counts as 0. Jumps strictly grow, so ``shards`` steps always suffice; about
    ln(shards) are made, hence 64 steps are tried before the full number.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    k = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    start = F.struct(
        F.shiftrightunsigned(k, 32).alias("h"), k.bitwiseAND(F.lit(_LOW32)).alias("l"),
        F.lit(-1).cast("long").alias("b"), F.lit(0).cast("long").alias("j"))

    def step(s: Column, _: Column) -> Column:
        h, l = _next_state(s["h"], s["l"])
        jump = F.floor((s["j"] + 1).cast("double")
                       * (F.lit(2147483648.0) / (F.shiftright(h, 1) + 1).cast("double"))).cast("long")
        moved = F.struct(h.alias("h"), l.alias("l"), s["j"].alias("b"), jump.alias("j"))
        return F.when(s["j"] < shards, moved).otherwise(s)

    def run(steps: int) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, step)

    if shards <= _QUICK_STEPS:
        return run(shards)["b"].cast("int")
    quick = run(_QUICK_STEPS)
    return F.when(quick["j"] >= shards, quick["b"]).otherwise(run(shards)["b"]).cast("int")


def key_of(col: Column, dtype: str) -> Column:
    """Integer keys are used as they are; any other key by 60 bits of its md5."""
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        return col.cast("long")
    return F.conv(F.substring(F.md5(col.cast("string").cast("binary")), 1, 15), 16, 10).cast("long")


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    * size: UTF-8 bytes of the text plus 1 (NULL text: 1, checksum 0, like an empty text).
    * a NULL key is hashed as key 0; equal keys share a shard, repeated rows get
      consecutive slots.
    * slot: 0, 1, 2, ... without gaps inside each shard, ordered by key, checksum, size.
    * an empty table gives an empty result; other columns of ``docs`` are ignored.
    """
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    hashed = key_of(F.col(f"`{key}`"), dict(docs.dtypes)[key])
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        (F.octet_length(body).cast("long") + 1).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        jump_hash(hashed, shards).alias("shard"),
        jump_hash(hashed, shards + 1).alias("grown_shard"),
        F.monotonically_increasing_id().alias("tie"))
    order = ["shard", "doc_id", "text_crc32", "size", "tie"]
    placed = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie"))
    at = placed.withColumn("at", F.monotonically_increasing_id())
    at = (at.withColumn("part", F.shiftright("at", 33))
          .withColumn("at", F.col("at").bitwiseAND(F.lit((1 << 33) - 1))))
    # One row per partition and shard (at most partitions + shards in total, as the rows
    # are range-ordered by shard): small enough to broadcast at any input size.
    runs = at.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select("shard", "part", (
        F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"))
    return (at.join(F.broadcast(before), ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("at") + F.col("shift")).alias("slot"), "grown_shard"))
