"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import checkpoint_root

# Word and symbol rules that the query contracts state.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
HELD_OUT_MODULUS, HELD_OUT_REMAINDER = 3, 1

PACKED_ROWS = 100_000  # narrow rows to a task


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there.

    Cuts the lineage, so a lost executor costs no recomputation of the text scan, and
    pins values such as row ids. Use it on narrow frames (no texts).
    """
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(checkpoint_root(df.sparkSession))
    return df.checkpoint(eager=True)


def stage_in_few(df: DataFrame) -> DataFrame:
    """``stage`` in files of about the session's advisory size, not one per task of a scan.

    For narrow frames made from texts. Every file that Hadoop's local file system creates starts
    ``chmod`` processes, each of which shares all of the executor's memory for an instant.
    """
    return stage(df.hint("rebalance"))


def packed(df: DataFrame, rows: int = PACKED_ROWS) -> tuple[DataFrame, int]:
    """``df`` staged, read in partitions of about ``rows`` rows, and its number of rows.

    For narrow frames much smaller than their sources: else every later job on a few rows runs
    one task, and writes one file, per shuffle partition of the session.
    """
    held = stage(df)
    n = held.count()
    return held.coalesce(parts(n, rows)), n


def parts(n: int, rows: int = PACKED_ROWS) -> int:
    return n // rows + 1


@contextmanager
def small_batches(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """Column and Arrow batches of at most ``rows`` rows for the jobs run inside, for rows with
    whole texts: both hold a batch's texts in one buffer. The session's settings are restored."""
    names = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")
    before = {n: spark.conf.get(n) for n in names}
    for n, v in before.items():
        spark.conf.set(n, min(rows, int(v)) if int(v) > 0 else rows)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def held_out(doc_id: Column) -> Column:
    """True for documents that no learner may see (a NULL id counts as held out)."""
    r = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(HELD_OUT_MODULUS))
    return F.coalesce(r == HELD_OUT_REMAINDER, F.lit(True))


def group_key(value: Column) -> Column:
    """A group's value as a string that sorts NULL first, then bytewise; never NULL."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.lit("="), s), F.lit(""))


def least_rows(rows: DataFrame, by: str, place: str, most: int) -> DataFrame:
    """Of the distinct rows of ``rows``, at most the ``most`` with the least values of ``place``
    (60 uniform bits) per ``by`` (few groups). Staged.

    The bound is exact: equal rows, however many, are one. So that one group's task never gets
    more than a few times ``most`` rows, those beyond four times the place that ``most`` rows
    reach by an estimate of the distinct rows are left out first.
    """
    held = stage(rows)
    n = held.groupBy(by).agg(F.approx_count_distinct(place).alias("n")).withColumnRenamed(by, "__by")
    upto = F.least(F.lit(1.0), F.lit(4.0 * most) / F.col("n")) * float(1 << 60)
    near = held.join(F.broadcast(n), F.col(by).eqNullSafe(F.col("__by"))).filter(F.col(place) <= upto).select(*rows.columns)
    order = Window.partitionBy(by).orderBy(place, *[c for c in rows.columns if c not in (by, place)])
    return stage(near.distinct().withColumn("__no", F.row_number().over(order)).filter(F.col("__no") <= most).drop("__no"))


def hash60(*parts: Column) -> Column:
    """60 uniform bits of the md5 of the parts joined by ':' (NULL counts as '')."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")
