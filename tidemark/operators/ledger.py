"""File ledger (R1, O3, F5, K6-K9): which landing file is in which batch and state.

The ledger is an append-only table of state changes
``(path, batch_id, batch_time, state, updated_at, seq, watermark_us)``; the
current state of a path is its latest row by ``(updated_at, seq)``. It replaces
the manifest file and the manifest delete, and it is the record of truth for
archive/quarantine (keyed by the full path, so equal basenames in different
folders stay apart).

Layout: state changes are appended under ``log/day=<yyyy-mm-dd>``;
``compact_ledger`` folds everything before a day into
``snapshot/upto=<day>`` (latest row per path). Readers use the newest
committed snapshot plus the log days from its cut-off, addressed by path, so
the ledger read by every batch stays small however long the pipeline runs.
"""

from __future__ import annotations

import itertools
import time
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import literal_rows
from tidemark.schemas import LEDGER_SCHEMA

_counter = itertools.count()


def _seq() -> int:
    return (time.time_ns() // 1000) * 1000 + next(_counter) % 1000  # micros x 1000 + counter


def current_state(ledger: DataFrame) -> DataFrame:
    """Latest state per file (path, version) (``max_by`` over ``(updated_at, seq)``; partial
    aggregation keeps a file with very many changes cheap)."""
    latest = F.max_by(F.struct("state", "batch_id", "batch_time", "watermark_us"),
                      F.struct("updated_at", "seq"))
    return ledger.groupBy("path", "version").agg(latest.alias("s")).select("path", "version", "s.*")


def next_batch(listing: DataFrame, ledger: DataFrame, max_files: int, path_col: str = "path") -> DataFrame:
    """First ``max_files`` listed paths (lexicographic) the ledger has never seen.

    The ledger holds every path ever seen and only grows; the listing is the
    bounded side. The unseen paths come from the insert-only merge operator:
    the listing is measured and broadcast, the ledger is probed map-side
    (never shuffled), and a listing too large to broadcast falls back to a
    shuffle anti-join. ``orderBy + limit`` plans as TakeOrderedAndProject: each
    task keeps its top ``max_files``, so nothing is sorted as a whole.
    """
    from tidemark.operators.merge import merge_insert

    keys = [path_col, "version"] if "version" in listing.columns else [path_col]
    seen = ledger.select(F.col("path").alias(path_col), "version").select(*keys)
    return merge_insert(seen, listing, keys).orderBy(path_col).limit(max_files)


@dataclass(frozen=True)
class PendingBatch:
    batch_id: str
    batch_time: datetime
    paths: list[str]


def files_of(paths) -> list[tuple[str, int | None]]:
    """``[path]`` or ``[(path, version)]`` -> ``[(path, version)]``."""
    return [(p, None) if isinstance(p, str) else (p[0], p[1]) for p in paths]


def names_of(paths) -> list[str]:
    return [p for p, _ in files_of(paths)]


def ledger_rows(spark: SparkSession, paths, batch_id: str, batch_time: datetime,
                state: str | tuple[str, ...], watermark_us: int | None = None,
                updated_at: datetime | None = None, key_range: tuple[int, int] | None = None,
                key_blocks: int | None = None) -> DataFrame:
    """State-change rows for one batch (at most ``max_files`` files per state).

    ``paths`` holds paths or (path, version) pairs. Several states are recorded
    in order (increasing ``seq``) by one write. ``key_range`` is the range of
    merge keys the batch inserted (``(1, 0)`` = none), ``key_blocks`` the size of their index.
    """
    now = updated_at or datetime.now(timezone.utc)
    states = (state,) if isinstance(state, str) else tuple(state)
    kmin, kmax = key_range if key_range is not None else (None, None)
    rows = []
    for st in states:
        seq = _seq()
        rows += [(p, batch_id, batch_time, st, now, seq, watermark_us, v, kmin, kmax, key_blocks) for p, v in files_of(paths)]
    return literal_rows(spark, rows, LEDGER_SCHEMA)


def record(spark: SparkSession, ledger_path: str, paths: list[str], batch_id: str, batch_time: datetime,
           state: str | tuple[str, ...], watermark_us: int | None = None, at: datetime | None = None,
           key_range: tuple[int, int] | None = None, key_blocks: int | None = None) -> None:
    now = (at or datetime.now(timezone.utc)).astimezone(timezone.utc)
    ledger_rows(spark, paths, batch_id, batch_time, state, watermark_us, updated_at=now,
                key_range=key_range, key_blocks=key_blocks).coalesce(1) \
        .write.mode("append").parquet(f"{ledger_path}/log/day={now:%Y-%m-%d}")


def batches_to_probe(spark: SparkSession, ledger: DataFrame, folders: list[str], lo: int | None,
                     hi: int | None) -> dict[str, int | None]:
    """Batch folders of the target that may hold keys in ``[lo, hi]``, and the size of their key index.

    A folder is skipped only when the ledger recorded the key range its batch inserted and
    that range misses ``[lo, hi]`` (None: no range is known); folders the ledger knows
    nothing about are always kept, and have no index (None).
    """
    if not folders:
        return {}
    known = (ledger.filter(F.col("state") == "archived").groupBy("batch_id")
             .agg(F.min("key_min").alias("kmin"), F.max("key_max").alias("kmax"), F.max("key_blocks").alias("blocks")))
    # one array literal, exploded in the JVM (no Python worker)
    names = spark.range(0, 1, 1, 1).select(F.explode(F.lit(list(folders))).alias("batch_id"))
    keep = names.join(known, "batch_id", "left")
    if lo is not None:
        keep = keep.filter(F.col("kmin").isNull() | ((F.col("kmax") >= F.lit(lo)) & (F.col("kmin") <= F.lit(hi))))
    return {r["batch_id"]: r["blocks"] for r in keep.select("batch_id", "blocks").collect()}


def _ledger_parts(spark: SparkSession, ledger_path: str) -> tuple[str | None, list[str]]:
    from tidemark.sources.fs import child_dirs

    snaps = [n[len("upto="):] for n, ok in child_dirs(spark, f"{ledger_path}/snapshot")
             if ok and n.startswith("upto=")]
    upto = max(snaps) if snaps else None
    days = [n[len("day="):] for n, _ in child_dirs(spark, f"{ledger_path}/log") if n.startswith("day=")]
    return upto, sorted(d for d in days if upto is None or d >= upto)


def read_ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Newest committed snapshot + the log days from its cut-off (empty ledger if none)."""
    upto, days = _ledger_parts(spark, ledger_path)
    paths = ([f"{ledger_path}/snapshot/upto={upto}"] if upto else []) + [f"{ledger_path}/log/day={d}" for d in days]
    if not paths:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(*paths)


def latest_rows(ledger: DataFrame) -> DataFrame:
    """The whole latest row of each file (the content of a snapshot)."""
    row = F.struct(*[F.col(c) for c in LEDGER_SCHEMA.fieldNames()])
    return (ledger.groupBy("path", "version").agg(F.max_by(row, F.struct("updated_at", "seq")).alias("r"))
            .select("r.*"))


def compact_ledger(spark: SparkSession, ledger_path: str, upto: str | None = None, purge: bool = False) -> str | None:
    """Fold the snapshot and the log days before ``upto`` (default and latest: today, UTC) into a new snapshot.

    The snapshot is only used once its write committed (``_SUCCESS``); log
    days at or after ``upto`` stay in the log. ``purge`` removes the folded
    log days afterwards (readers ignore them either way). Returns the cut-off used.
    """
    from tidemark.sources.fs import delete_dir

    today = f"{datetime.now(timezone.utc):%Y-%m-%d}"
    upto = min(upto or today, today)  # never fold the current day: it still receives rows
    old, days = _ledger_parts(spark, ledger_path)
    fold = [d for d in days if d < upto]
    if not fold or (old is not None and upto <= old):
        return old
    paths = ([f"{ledger_path}/snapshot/upto={old}"] if old else []) + [f"{ledger_path}/log/day={d}" for d in fold]
    latest_rows(spark.read.schema(LEDGER_SCHEMA).parquet(*paths)) \
        .write.mode("overwrite").parquet(f"{ledger_path}/snapshot/upto={upto}")
    if purge:
        for d in fold:
            delete_dir(spark, f"{ledger_path}/log/day={d}")
    return upto


def log_days_since_snapshot(spark: SparkSession, ledger_path: str) -> int:
    return len(_ledger_parts(spark, ledger_path)[1])


def pending_batch(ledger: DataFrame) -> PendingBatch | None:
    """The first batch that was started but not finished (crash before ``loaded``/``quarantined``).

    All its files come back, whatever ``max_files`` is now: a batch is bounded by the
    setting under which it was recorded.
    """
    rows = current_state(ledger).filter(F.col("state") == "pending")
    first = rows.agg(F.min(F.struct("batch_id", "batch_time")).alias("b")).first()["b"]
    if first is None:
        return None
    paths = [r["path"] for r in rows.filter(F.col("batch_id") == first["batch_id"]).select("path").collect()]
    return PendingBatch(first["batch_id"], first["batch_time"], sorted(paths))


@dataclass(frozen=True)
class LedgerSummary:
    last_batch_id: str | None
    last_batch_time: datetime | None
    last_state: str | None  # state of the most recent row (of the latest batch)
    watermark_us: int | None  # mark recorded at the last completed merge
    merged: int  # rows of merged batches (loaded or archived; a quarantined batch merged nothing)

    @property
    def pending(self) -> bool:
        return self.last_state == "pending"


def summarise_ledger(ledger: DataFrame) -> LedgerSummary:
    """Everything a batch needs to know about the ledger, from one aggregate (no shuffle).

    Batches run one after the other, so only the latest batch can be pending,
    and a pending batch has no watermark yet: the overall max watermark is the
    mark of the target without that batch.
    """
    latest = F.struct("batch_id", "updated_at", "seq")
    row = ledger.agg(
        F.max("batch_id").alias("b"),
        F.max("batch_time").alias("t"),
        F.max_by("state", latest).alias("s"),
        F.max("watermark_us").alias("w"),
        F.count_if(F.col("state").isin("loaded", "archived")).alias("c"),
    ).first()
    return LedgerSummary(row["b"], row["t"], row["s"], None if row["w"] is None else int(row["w"]), int(row["c"]))


def batch_paths(ledger: DataFrame, batch_id: str) -> list[tuple[str, int | None]]:
    """(path, version) of all files of one batch, as many as were recorded when it was started."""
    rows = (ledger.filter((F.col("batch_id") == batch_id) & (F.col("state") == "pending"))
            .select("path", "version").distinct().collect())
    return sorted((r[0], r[1]) for r in rows)


def unmerged_batches(spark: SparkSession, ledger: DataFrame, folders: list[str]) -> list[str]:
    """Those batch folders (ids) that the ledger does not record as merged."""
    if not folders:
        return []
    merged = ledger.filter(F.col("state").isin("loaded", "archived")).select("batch_id").distinct()
    names = spark.range(0, 1, 1, 1).select(F.explode(F.lit(list(folders))).alias("batch_id"))
    return sorted(r[0] for r in names.join(merged, "batch_id", "left_anti").collect())
