"""Key index of a table's batch folders: one mergeable Bloom filter per folder.

Keys that do not grow over time defeat min/max statistics: every folder's range covers every
batch. A folder's filter says which keys it cannot hold, so a batch probes only the folders
in which at least one of its keys may be.

A filter is a table of bitmaps of ``BLOCK_BITS`` bits. A key's hash picks one bitmap (their
number is a power of two) and ``HASHES`` bits in it. So a filter of any size is built by one
aggregate with map-side partial bitmaps, no row holds more than 4 KB, and a probe reads the
bitmaps its keys fall into, not the whole filter. Filters merge by OR, also filters of
different size: the larger one folds onto the smaller one.

At ``KEY_BITS`` bits a key, about one absent key in 25,000 is taken for present; present keys
are always found. Rounding up to a power of two only adds bits. A folder of few rows is read
faster than its filter is: it gets one when it is packed with others.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BITS = 1 << 15  # the bitmap aggregates of Spark SQL work on this size
KEY_BITS = 24
HASHES = 8
MIN_ROWS = 100_000  # folders of fewer rows are not worth a filter
MAX_LITERAL_BLOCKS = 2000  # so many bitmap numbers are pushed into the index scan as literals
INDEX_SCHEMA = T.StructType([
    T.StructField("blocks", T.IntegerType()),
    T.StructField("block", T.IntegerType()),
    T.StructField("bitmap", T.BinaryType()),
])


def blocks_for(rows: int) -> int:
    """Bitmaps of a filter for ``rows`` keys."""
    need = -(-max(rows, 1) * KEY_BITS // BLOCK_BITS)
    return 1 << (need - 1).bit_length()


def _hashes(key: Column, dtype: T.DataType) -> tuple[Column, Column]:
    """Two independent 64-bit hashes; integers of every width hash alike."""
    k = key.cast("long") if isinstance(dtype, T.IntegralType) else key
    return F.xxhash64(k), F.xxhash64(F.lit(HASHES), k)


def _block(h: Column, blocks: Column) -> Column:
    return h.bitwiseAND(blocks.cast("long") - 1).cast("int")


def _bits(h: Column) -> list[Column]:
    """The key's bits inside its bitmap: an odd stride modulo a power of two never repeats."""
    first, stride = h, F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return [(first + stride * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(HASHES)]


def _has_bit(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, bit.bitwiseAND(F.lit(7)).cast("int")) == 1


def build(rows: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter of ``key``: (blocks, block, bitmap). NULL keys match nothing and are left out."""
    h, g = _hashes(F.col("k"), rows.schema[key].dataType)
    placed = (rows.select(F.col(f"`{key}`").alias("k")).filter(F.col("k").isNotNull())
              .select(_block(h, F.lit(blocks)).alias("block"), F.explode(F.array(*_bits(g))).alias("bit")))
    return (placed.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
            .select(F.lit(blocks).alias("blocks"), "block", "bitmap"))


def folded(index: DataFrame, blocks: int) -> DataFrame:
    """Filters of at least ``blocks`` bitmaps each, merged into one of that size."""
    return (index.select(F.lit(blocks).alias("blocks"), F.col("block").bitwiseAND(F.lit(blocks - 1)).alias("block"), "bitmap")
            .groupBy("blocks", "block").agg(F.bitmap_or_agg("bitmap").alias("bitmap")))


def placed_keys(keys: DataFrame, key: str, sizes: list[int]) -> DataFrame:
    """(key, blocks, block, bits) of every distinct non-NULL key in filters of each of ``sizes``
    (powers of two, so at most about 30)."""
    h, g = _hashes(F.col("key"), keys.schema[key].dataType)
    return (keys.select(F.col(f"`{key}`").alias("key")).filter(F.col("key").isNotNull()).distinct()
            .withColumn("blocks", F.explode(F.array(*[F.lit(n) for n in sizes])))
            .select("key", "blocks", _block(h, F.col("blocks")).alias("block"), F.array(*_bits(g)).alias("bits")))


def may_hold(index: DataFrame, placed: DataFrame) -> DataFrame:
    """Rows of ``index`` joined with the keys of ``placed`` (small: broadcast) that they may hold."""
    near = index.join(F.broadcast(placed), ["blocks", "block"])
    found = reduce(lambda a, b: a & b, [_has_bit(F.col("bitmap"), F.col("bits")[i]) for i in range(HASHES)])
    return near.filter(found).drop("bitmap", "bits", "block", "blocks")


def write_index(rows: DataFrame, key: str, count: int, path: str) -> int:
    """Writes the filter of ``rows`` (``count`` of them) to ``path``; returns its number of bitmaps.

    Files are sorted by bitmap number with small pages, so a probe skips what it does not need.
    """
    blocks = blocks_for(count)
    (build(rows, key, blocks).sortWithinPartitions("block").write.mode("overwrite")
     .option("parquet.page.size", str(64 * 1024)).option("parquet.block.size", str(8 * 1024 * 1024)).parquet(path))
    return blocks


def read_index(spark: SparkSession, root: str, folders: list[str], column: str) -> DataFrame:
    """The filters of the given folders below ``root`` (``<column>=<folder>``), with ``column``."""
    schema = T.StructType([*INDEX_SCHEMA.fields, T.StructField(column, T.StringType())])
    return spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{column}={f}" for f in folders])


def folders_that_may_hold(spark: SparkSession, root: str, sizes: dict[str, int], keys: DataFrame, key: str,
                          column: str, rows: int | None = None) -> list[str]:
    """Of the indexed folders in ``sizes`` (folder -> bitmaps), those that may hold one of ``keys``.

    ``keys`` must be small enough to broadcast. If they are few (``rows``, if known, says so
    without a job), the bitmap numbers are pushed into the index scan as literals, so only
    their pages are read; the answer is the same without.
    """
    if not sizes:
        return []
    placed = placed_keys(keys, key, sorted(set(sizes.values())))
    index = read_index(spark, root, sorted(sizes), column)
    if max(sizes.values()) > 1 and (rows is None or rows <= MAX_LITERAL_BLOCKS):
        wanted = [r[0] for r in placed.select("block").distinct().limit(MAX_LITERAL_BLOCKS + 1).collect()]
        if len(wanted) <= MAX_LITERAL_BLOCKS:
            index = index.filter(F.col("block").isin(wanted))
    hits = may_hold(index, placed).select(column).distinct()
    return sorted(r[0] for r in hits.collect())
