"""Path-based tables.

A table is a parquet folder plus a declared schema of visible columns and a
list of hidden partition columns derived on write (``batch_id``,
``order_month``) and dropped on read. Appends resolve columns by name.
Batch writes use dynamic partition overwrite, so writing the same batch again
replaces its own folders instead of duplicating rows.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.layout import MONTH_COL, cluster_for_write, with_month
from tidemark.session import scratch_path
from tidemark.sources.fs import qualified, scan_roots

BATCH_COL = "batch_id"
_HIDDEN_TYPES = {BATCH_COL: T.StringType(), MONTH_COL: T.IntegerType()}


@dataclass(frozen=True)
class Table:
    path: str
    schema: T.StructType
    partition_by: tuple[str, ...] = field(default_factory=tuple)
    month_source: str = "orderdate"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    def full_schema(self) -> T.StructType:
        return T.StructType(list(self.schema.fields)
                            + [T.StructField(p, _HIDDEN_TYPES.get(p, T.StringType())) for p in self.partition_by])


class SchemaMismatch(ValueError):
    pass


def ensure_namespace(spark: SparkSession, name: str) -> None:
    """K11 / F3."""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")


def create_table(spark: SparkSession, table: Table, replace_existing: bool = False) -> Table:
    """An empty table folder with the declared schema (replace = drop content)."""
    empty = spark.createDataFrame([], table.full_schema())
    writer = empty.write.mode("overwrite" if replace_existing else "ignore")
    if table.partition_by:
        writer = writer.partitionBy(*table.partition_by)
    writer.parquet(table.path)
    return table


def read_table(spark: SparkSession, table: Table, months: tuple[int, int] | None = None,
               batches: list[str] | None = None, exclude_batch: str | None = None,
               keep_hidden: bool = False) -> DataFrame:
    """Declared schema, no inference; partition predicates prune folders."""
    df = spark.read.schema(table.full_schema()).parquet(table.path)
    if months is not None and MONTH_COL in table.partition_by:
        df = df.filter(F.col(MONTH_COL).between(*months))
    if batches is not None and BATCH_COL in table.partition_by:
        df = df.filter(F.col(BATCH_COL).isin(batches))
    if exclude_batch is not None and BATCH_COL in table.partition_by:
        df = df.filter(F.col(BATCH_COL).isNull() | (F.col(BATCH_COL) != exclude_batch))
    return df if keep_hidden else df.select(*table.columns)


def read_batch(spark: SparkSession, table: Table, batch_id: str) -> DataFrame:
    """One batch's folder, addressed by path (no listing of the rest of the table).

    Hidden columns are kept; a batch that wrote no rows reads as empty.
    """
    folder = f"{table.path.rstrip('/')}/{BATCH_COL}={batch_id}"
    try:
        return spark.read.schema(table.full_schema()).option("basePath", table.path).parquet(folder)
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            return spark.createDataFrame([], table.full_schema())
        raise


def read_batches(spark: SparkSession, table: Table, batch_ids: list[str], keep_hidden: bool = False) -> DataFrame:
    """The given batch folders only, addressed by path (no listing of the rest of the table)."""
    if not batch_ids:
        return spark.createDataFrame([], table.full_schema() if keep_hidden else table.schema)
    folders = [f"{table.path.rstrip('/')}/{BATCH_COL}={b}" for b in batch_ids]
    df = spark.read.schema(table.full_schema()).option("basePath", table.path).parquet(*folders)
    return df if keep_hidden else df.select(*table.columns)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """By-name column resolution (K1): same column set required; types cast to the table's."""
    have, want = set(df.columns), [f.name for f in schema.fields]
    missing, extra = [c for c in want if c not in have], sorted(have - set(want))
    if missing or extra:
        raise SchemaMismatch(f"missing columns {missing}, unexpected columns {extra}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def _with_hidden(df: DataFrame, table: Table, batch_id: str | None, cluster: str = "range") -> DataFrame:
    out = df
    if BATCH_COL in table.partition_by:
        out = out.withColumn(BATCH_COL, F.lit(batch_id).cast("string"))
    if MONTH_COL in table.partition_by:
        out = with_month(out, table.month_source)
        if cluster == "range":
            out = cluster_for_write(out, MONTH_COL, table.month_source)
        else:  # "local": keep the input split, sort each task's rows by month (no shuffle)
            out = out.sortWithinPartitions(MONTH_COL, table.month_source)
    return out


def append(table: Table, df: DataFrame, batch_id: str | None = None, cluster: str = "range") -> None:
    """K1: append by name. With a ``batch_id`` partition the write is replayable:
    dynamic overwrite replaces only this batch's folders.

    ``cluster="range"`` range-partitions by (month, instant) before writing (few,
    well-sized files; a sampling job plus one shuffle). ``cluster="local"``
    writes each input split as it is, sorted by month: no shuffle, and no task
    can be overloaded by a hot month; meant for bounded batches.
    """
    out = _with_hidden(conform(df, table.schema), table, batch_id, cluster)
    writer = out.write
    if batch_id is not None and BATCH_COL in table.partition_by:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    if table.partition_by:
        writer = writer.partitionBy(*table.partition_by)
    writer.parquet(table.path)


def _reads_from(df: DataFrame, path: str) -> bool:
    """Does ``df`` read below ``path``? Decided by the roots of its file scans as the plan names
    them (a few qualified folders), not by its files."""
    spark = df.sparkSession
    own = qualified(spark, path) + "/"
    roots = scan_roots(df)
    return any((r + "/").startswith(own) or own.startswith(r + "/") for r in roots)


def overwrite(spark: SparkSession, table: Table, df: DataFrame, schema: T.StructType | None = None) -> Table:
    """K2: replace content (and schema) of the table.

    A frame that reads the table itself is staged under the checkpoint dir
    first: overwriting a folder while reading it loses files.
    """
    new = replace(table, schema=schema or T.StructType([f for f in df.schema.fields]))
    src = df
    if _reads_from(df, table.path):
        stage = scratch_path(spark, "stage")
        df.write.parquet(stage)
        src = spark.read.parquet(stage)
    out = _with_hidden(conform(src, new.schema), new, None)
    writer = out.write.mode("overwrite")
    if new.partition_by:
        writer = writer.partitionBy(*new.partition_by)
    writer.parquet(new.path)
    return new


def repartition_table(spark: SparkSession, table: Table, new_path: str, by_month: bool = True) -> Table:
    """Rewrite into ``new_path`` with a new partition spec (month clustering).

    Batch folders are folded (compaction). The caller swaps its catalog
    location to the returned table; the old folder is left as it was.
    """
    parts = (MONTH_COL,) if by_month else ()
    new = replace(table, path=new_path, partition_by=parts)
    append(new, read_table(spark, table))
    return new


def upsert_table(spark: SparkSession, table: Table, source: DataFrame, keys: str | list[str],
                 verify_unique: bool = True) -> int:
    """R4 on a stored table: rows whose key is in ``source`` are replaced, other source rows inserted.

    Only the touched partitions are rewritten (those holding matched target
    rows, and those receiving source rows). Their new content is staged below
    the checkpoint dir and swapped in by dynamic partition overwrite; folders
    left without rows are removed afterwards. Untouched partitions are neither
    read back nor rewritten. Re-running the same upsert converges to the same
    table. Returns the number of partitions touched.
    """
    from tidemark.operators.merge import _keys, check_unique, matched_keys
    from tidemark.operators.sizing import fits_broadcast, measure

    keys = _keys(keys)
    if verify_unique:
        check_unique(source, keys)
    src = conform(source, table.schema)
    if not table.partition_by:
        overwrite(spark, table, merge_upsert_frame(read_table(spark, table), src, keys), table.schema)
        return 1
    parts = list(table.partition_by)
    target = read_table(spark, table, keep_hidden=True)
    hit = matched_keys(target, src, keys)
    hit = F.broadcast(hit) if hit is not None else src.select(*keys).distinct()
    new_batch = ("upsert-" + uuid.uuid4().hex[:12]) if BATCH_COL in parts else None
    src_h = _with_hidden(src, table, new_batch, cluster="local")
    touched = (target.join(hit, keys, "left_semi").select(*parts)
               .unionByName(src_h.select(*parts)).distinct())
    size = measure(touched)
    t_side = F.broadcast(touched) if fits_broadcast(size, 64 * 1024 * 1024) else touched
    kept = (target.join(t_side, _null_safe(target, t_side, parts), "left_semi")
            .join(hit, keys, "left_anti"))
    content = kept.unionByName(src_h.select(*kept.columns))
    stage = scratch_path(spark, "upsert")
    content.write.partitionBy(*parts).parquet(f"{stage}/content")
    touched.write.parquet(f"{stage}/touched")  # staged too: the table's old files vanish on swap
    staged = spark.read.schema(table.full_schema()).parquet(f"{stage}/content")
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts).parquet(table.path))
    was = spark.read.parquet(f"{stage}/touched")
    present = staged.select(*parts).distinct()
    emptied = was.join(present, _null_safe(was, present, parts), "left_anti").collect()  # <= size.rows
    _delete_partitions(spark, table.path, parts, [r.asDict() for r in emptied])
    return size.rows


def _null_safe(left: DataFrame, right: DataFrame, cols: list[str]):
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def _delete_partitions(spark: SparkSession, path: str, parts: list[str], specs: list[dict]) -> None:
    """Remove partition folders that an upsert emptied (bounded list, Hadoop FileSystem)."""
    from tidemark.sources.fs import delete_dir

    for spec in specs:
        sub = "/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if spec[c] is None else spec[c]}" for c in parts)
        delete_dir(spark, f"{path.rstrip('/')}/{sub}")


def merge_upsert_frame(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    from tidemark.operators.merge import merge_upsert

    return merge_upsert(target, source, keys, verify_unique=False)
