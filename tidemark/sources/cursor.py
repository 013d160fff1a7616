"""Listing that stops at ``max_files`` (S1, O3): a resumable cursor over the landing folders.

A landing area with one folder per day (or hour, or partner) gains folders for ever, and a
whole listing reads all of them for every batch. The cursor remembers the folders whose files
the ledger holds completely, with their modification time: they are skipped until that time
changes, which is how a late file shows. The others are listed in name order, one call each,
and only until enough new files are found. So a batch costs one call for the landing folder
itself and one per folder it takes files from, however many folders there are.

A folder is remembered only when every file in it is known to the ledger and it has not
changed for ``GRACE_MS``, so a file that arrives while it is being listed is not lost. Stores
whose folders have no modification time get a full pass of the folders instead
(``modified`` is 0 there and never counts as unchanged). A folder with sub-folders is listed
with all of them, every time.

The cursor is a cache: without it (deleted, or written by a run that died) the next batch
lists more folders and finds the same files.
"""

from __future__ import annotations

import fnmatch
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import literal_rows
from tidemark.sources.fs import FileInfo, child_files, delete_dir

GRACE_MS = 2000
CURSOR_SCHEMA = T.StructType([
    T.StructField("folder", T.StringType()),
    T.StructField("modified", T.LongType()),
    T.StructField("at", T.LongType()),
])


@dataclass
class Found:
    """Files of the next batch as (path, version), and what the cursor may skip from now on."""

    files: list[tuple[str, int]] = field(default_factory=list)
    finished: dict[str, int] = field(default_factory=dict)
    listed: int = 0  # listing calls made


def read_cursor(spark: SparkSession, path: str) -> dict[str, int]:
    """folder -> modification time of the finished folders."""
    if not any(f.name.endswith(".parquet") for f in child_files(spark, path)):
        return {}
    rows = (spark.read.schema(CURSOR_SCHEMA).parquet(path).groupBy("folder")
            .agg(F.max_by("modified", "at").alias("modified")).collect())
    return {r["folder"]: r["modified"] for r in rows}


def advance_cursor(spark: SparkSession, path: str, finished: dict[str, int]) -> None:
    """Appends newly finished folders (a batch finishes few)."""
    if finished:
        now = time.time_ns() // 1000
        literal_rows(spark, [(f, m, now) for f, m in sorted(finished.items())], CURSOR_SCHEMA).coalesce(1) \
            .write.mode("append").parquet(path)


def reset_cursor(spark: SparkSession, path: str) -> None:
    """Forgets all folders: the next batch looks into each of them again."""
    delete_dir(spark, path)


def _unknown(spark: SparkSession, files: list[FileInfo], ledger: DataFrame) -> list[FileInfo]:
    """Those files of one folder that the ledger has never seen, in name order."""
    schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("version", T.LongType())])
    listed = literal_rows(spark, [(f.path, f.modified) for f in files], schema)
    seen = ledger.select("path", "version").join(F.broadcast(listed), ["path", "version"], "left_semi").distinct()
    known = {(r["path"], r["version"]) for r in seen.collect()}  # at most the folder's files
    return sorted((f for f in files if (f.path, f.modified) not in known), key=lambda f: f.path)


def next_files(spark: SparkSession, landing: str, ledger: DataFrame, finished: dict[str, int], max_files: int,
               pattern: str = "*.parquet", now_ms: int | None = None) -> Found:
    """The first ``max_files`` new files by path, looking only into folders that may hold some."""
    now = int(time.time() * 1000) if now_ms is None else now_ms
    found = Found()

    def files_below(folder: str) -> tuple[list[FileInfo], bool]:
        found.listed += 1
        out, nested = [], False
        for f in child_files(spark, folder):
            if f.name.startswith(("_", ".")):
                continue
            if f.is_folder:
                nested = True
                out += files_below(f.path)[0]
            elif fnmatch.fnmatch(f.name, pattern):
                out.append(f)
        return out, nested

    found.listed += 1
    top = [f for f in child_files(spark, landing) if not f.name.startswith(("_", "."))]
    loose = [f for f in top if not f.is_folder and fnmatch.fnmatch(f.name, pattern)]
    # files directly in the landing folder stand between its folders, by path
    units = sorted([(f.path + "/", f) for f in top if f.is_folder] + [(f.path, f) for f in loose])
    new_loose = {f.path for f in _unknown(spark, loose, ledger)} if loose else set()
    for _, unit in units:
        if len(found.files) >= max_files:
            break
        if not unit.is_folder:
            if unit.path in new_loose:
                found.files.append((unit.path, unit.modified))
            continue
        if unit.modified > 0 and finished.get(unit.path) == unit.modified:
            continue
        files, nested = files_below(unit.path)
        new = _unknown(spark, files, ledger) if files else []
        found.files += [(f.path, f.modified) for f in new]
        if not new and not nested and 0 < unit.modified < now - GRACE_MS:
            found.finished[unit.path] = unit.modified
    found.files = found.files[:max_files]
    return found
