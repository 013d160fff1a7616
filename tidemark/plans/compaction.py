"""Compaction of the pipeline's batch folders in place.

Every batch adds a folder to the raw and the enriched table. Neighbouring small folders are
packed into one of about ``target_bytes``; large ones are never rewritten, so the work is in
proportion to what was added since the last time.

Crash safety: the packed content is first written to a hidden folder of the table, which
readers skip. Then a journal row says which folders it replaces. From there on the
replacement is only finished, by whoever comes next: the hidden folder is renamed to its
batch folder, the replaced folders are deleted, the journal row is closed. Before the journal
row nothing has changed. ``finish_compactions`` is called by every batch before it reads a
table, so the pipeline never merges against both the old and the new folder.

What the ledger knows of the replaced folders (merged or not, key range, key index) is
carried on by the journal: its rows are read together with the ledger, as rows of the packed
folder. Only one compaction or batch of a lake runs at a time, like the pipeline itself.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import literal_rows
from tidemark.operators.key_index import MIN_ROWS, write_index
from tidemark.operators.ledger import read_ledger, summarise_ledger, unmerged_batches
from tidemark.plans.tables import BATCH_COL, Table, _with_hidden, read_batches
from tidemark.schemas import LEDGER_SCHEMA
from tidemark.sources.fs import child_entries, delete_dir, rename_dir

PACKED = "packed-"  # such batch folders hold merged rows only
TARGET_BYTES = 512 << 20
_HIDDEN = "_packing"
JOURNAL_SCHEMA = T.StructType([
    T.StructField("table_path", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("state", T.StringType()),  # "ready", then "done"
    T.StructField("replaced", T.ArrayType(T.StringType())),
    T.StructField("at", T.TimestampType()),
    T.StructField("key_min", T.LongType()),
    T.StructField("key_max", T.LongType()),
    T.StructField("key_blocks", T.IntegerType()),
])


@dataclass(frozen=True)
class Packing:
    batch_id: str
    folders: tuple[str, ...]


def _journal(root: str) -> str:
    return f"{root}/compactions"


def read_journal(spark: SparkSession, root: str) -> DataFrame | None:
    """None if nothing was ever packed."""
    if not any(n.endswith(".parquet") for n, _ in child_entries(spark, _journal(root))):
        return None
    return spark.read.schema(JOURNAL_SCHEMA).parquet(_journal(root))


def _note(spark: SparkSession, root: str, row: dict) -> None:
    values = tuple(row[f.name] for f in JOURNAL_SCHEMA.fields)
    literal_rows(spark, [values], JOURNAL_SCHEMA).coalesce(1).write.mode("append").parquet(_journal(root))


def folder_sizes(spark: SparkSession, table: Table, folders: list[str]) -> DataFrame:
    """(folder, bytes, files) of batch folders: file metadata only, listed by Spark."""
    paths = [f"{table.path}/{BATCH_COL}={f}" for f in folders]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths).select("path", "length")
    folder = F.regexp_extract("path", rf"/{BATCH_COL}=([^/]*)/", 1)
    return files.groupBy(folder.alias("folder")).agg(F.sum("length").alias("bytes"), F.count("*").alias("files"))


def plan_packing(spark: SparkSession, table: Table, folders: list[str], target_bytes: int = TARGET_BYTES) -> list[Packing]:
    """Which of ``folders`` to pack: neighbours in name order, those under half the target, by
    cumulative size; packs of one folder are left alone."""
    if len(folders) < 2:
        return []
    small = folder_sizes(spark, table, folders).filter(F.col("bytes") < target_bytes / 2)
    before = Window.orderBy("folder").rowsBetween(Window.unboundedPreceding, -1)  # one row per folder
    packs = small.withColumn("pack", F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / target_bytes))
    rows = packs.groupBy("pack").agg(F.sort_array(F.collect_list("folder")).alias("folders")).filter("size(folders) > 1")
    # a pack is named after its last folder, and so sorts in its place
    return [Packing(f"{PACKED}{r['folders'][-1].removeprefix(PACKED)}-{len(r['folders'])}", tuple(r["folders"]))
            for r in rows.orderBy("pack").collect()]


def _finish(spark: SparkSession, root: str, row: dict, index: str) -> None:
    place = f"{row['table_path']}/{BATCH_COL}={row['batch_id']}"
    hidden = f"{row['table_path']}/{_HIDDEN}/{row['batch_id']}"
    rename_dir(spark, hidden, place)  # skipped if it was done before
    for folder in row["replaced"]:
        delete_dir(spark, f"{row['table_path']}/{BATCH_COL}={folder}")
        delete_dir(spark, f"{index}/{BATCH_COL}={folder}")  # if it had one
    _note(spark, root, {**row, "state": "done"})


def finish_compactions(spark: SparkSession, root: str, journal: DataFrame | None = None) -> int:
    """Finishes replacements that a journal row announced and a crash interrupted."""
    if journal is None:
        journal = read_journal(spark, root)
    if journal is None:
        return 0
    done = journal.filter("state = 'done'").select("table_path", "batch_id")
    open_rows = journal.filter("state = 'ready'").join(done, ["table_path", "batch_id"], "left_anti").collect()
    for r in open_rows:
        _finish(spark, root, r.asDict(), f"{root}/key_index")
    return len(open_rows)


def as_ledger_rows(journal: DataFrame) -> DataFrame:
    """Packed folders as the ledger would record them: merged, with key range and index."""
    known = {"batch_id": F.col("batch_id"), "state": F.lit("archived"), "updated_at": F.col("at"),
             "key_min": F.col("key_min"), "key_max": F.col("key_max"), "key_blocks": F.col("key_blocks")}
    return journal.filter("state = 'ready'").select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in LEDGER_SCHEMA.fields])


def pack(spark: SparkSession, root: str, table: Table, packing: Packing, key: str | None, index: str | None,
         crash: Callable[[str], None] = lambda step: None, index_min_rows: int = MIN_ROWS) -> None:
    """Replaces the folders of one packing. ``key``: its range (if integral) and index are recorded.

    ``crash`` is called before each step (tests raise from it).
    """
    hidden = f"{table.path}/{_HIDDEN}/{packing.batch_id}"
    rows = read_batches(spark, table, list(packing.folders))
    crash("write")
    content = _with_hidden(rows, table, packing.batch_id).drop(BATCH_COL)
    months = [p for p in table.partition_by if p != BATCH_COL]
    writer = content.write.mode("overwrite")
    (writer.partitionBy(*months) if months else writer).parquet(hidden)
    key_min = key_max = blocks = None
    if key is not None:
        crash("index")
        written = spark.read.schema(table.full_schema()).parquet(hidden)
        integral = isinstance(table.schema[key].dataType, T.IntegralType)
        k = F.col(key)
        got = written.agg(F.count(k).alias("n"), F.min(k).alias("lo"), F.max(k).alias("hi")).first()
        if integral:
            key_min, key_max = (got["lo"], got["hi"]) if got["n"] else (1, 0)
        if index is not None and got["n"] >= index_min_rows:
            blocks = write_index(written, key, got["n"], f"{index}/{BATCH_COL}={packing.batch_id}")
    row = {"table_path": table.path, "batch_id": packing.batch_id, "replaced": list(packing.folders),
           "at": datetime.now(timezone.utc), "key_min": key_min, "key_max": key_max, "key_blocks": blocks}
    crash("journal")
    _note(spark, root, {**row, "state": "ready"})
    crash("swap")
    _finish(spark, root, row, f"{root}/key_index")


def compact(spark: SparkSession, cfg, table: Table, merged_only: bool, target_bytes: int = TARGET_BYTES,
            crash: Callable[[str], None] = lambda step: None) -> list[Packing]:
    """Packs the small batch folders of one table of the lake ``cfg`` describes.

    Folders of a pending batch are left alone, and so are, with ``merged_only`` (the raw
    table), those that the ledger does not record as merged. Returns what was packed.
    """
    finish_compactions(spark, cfg.root)
    delete_dir(spark, f"{table.path}/{_HIDDEN}")  # of a run that died before its journal row
    ledger = read_ledger(spark, cfg.ledger_path)
    summary = summarise_ledger(ledger)
    folders = [n.split("=", 1)[1] for n, is_dir in child_entries(spark, table.path)
               if is_dir and n.startswith(f"{BATCH_COL}=")]
    folders = [f for f in folders if f != "__HIVE_DEFAULT_PARTITION__"
               and not (summary.pending and f == summary.last_batch_id)]
    if merged_only:
        journal = read_journal(spark, cfg.root)
        known = ledger if journal is None else ledger.unionByName(as_ledger_rows(journal))
        folders = sorted(set(folders) - set(unmerged_batches(spark, known, folders)))
    packings = plan_packing(spark, table, folders, target_bytes)
    for p in packings:
        pack(spark, cfg.root, table, p, None if merged_only else cfg.key,
             cfg.key_index_path if cfg.key_index and not merged_only else None, crash, cfg.key_index_min_rows)
    return packings


def compact_lake(spark: SparkSession, cfg, target_bytes: int = TARGET_BYTES) -> dict[str, list[Packing]]:
    """Packs the raw and the enriched table."""
    dim_schema = cfg.dimension_schema or spark.read.parquet(f"{cfg.root}/dimension").schema
    return {"raw": compact(spark, cfg, cfg.raw_table(), True, target_bytes),
            "enriched": compact(spark, cfg, cfg.enriched_table(dim_schema), False, target_bytes)}

