"""The batch pipeline (R3): pick -> validate -> gate -> raw append -> increment -> enrich -> merge.

Replay safety (a retry after a crash at any point gives the same tables):

* the ledger row ``pending`` with a fixed ``(batch_id, batch_time, paths)`` is
  written before any table write; a retry finds it and reuses it;
* raw and enriched tables carry a leading ``batch_id`` partition and batch
  writes replace only their own folders (dynamic partition overwrite);
* the merge of batch X uses the enriched table without X's folder, both for
  the anti-join and for the high-water mark, and the mark is read from the
  ledger (recorded at each completed merge), not recomputed from the table;
* the ledger says ``loaded`` only after both writes.

What a batch reads: its own landing files, its own raw folder and those that the
ledger does not record as merged (after the first merge), the ledger (one snapshot + a few day folders), the dimension (size
checked once per version) and, for the anti-join, the key column of only
those enriched batch folders whose recorded key range overlaps its keys.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import derive_check_columns, epoch_to_timestamp, timestamp_to_micros
from tidemark.operators.enrich import enrich
from tidemark.operators.increment import high_water_mark, increment
from tidemark.operators.key_index import MIN_ROWS, folders_that_may_hold, write_index
from tidemark.operators.ledger import (LedgerSummary, batch_paths, batches_to_probe, compact_ledger, current_state,
                                       log_days_since_snapshot, names_of, next_batch, read_ledger, record,
                                       summarise_ledger, unmerged_batches)
from tidemark.operators.merge import merge_insert, source_key_size
from tidemark.operators.quality import Expectation, audit_frame, default_suite, gate, run_suite, write_audit
from tidemark.operators.sizing import fits_broadcast
from tidemark.plans.compaction import as_ledger_rows, finish_compactions, read_journal
from tidemark.plans.tables import (BATCH_COL, Table, append, create_table, overwrite, read_batch, read_batches,
                                   read_table)
from tidemark.schemas import (DEFAULT_MAX_FILES, DEFAULT_MIN_PASS_RATE, DEFAULT_MIN_RECORDS, DIMENSION_KEY,
                              RAW_SCHEMA, enriched_schema)
from tidemark.session import broadcast_threshold
from tidemark.sources.cursor import advance_cursor, next_files, read_cursor
from tidemark.sources.files import list_files, read_landing, schema_faults
from tidemark.sources.fs import child_entries, move_files

PARTS = (BATCH_COL, "order_month")


@dataclass(frozen=True)
class PipelineConfig:
    landing: str
    root: str
    max_files: int = DEFAULT_MAX_FILES
    suite: tuple[Expectation, ...] = field(default_factory=lambda: tuple(default_suite()))
    min_pass_rate: float = DEFAULT_MIN_PASS_RATE
    min_records: int = DEFAULT_MIN_RECORDS
    key: str = "invoiceid"
    fact_key: str = "state"
    dim_key: str = DIMENSION_KEY
    pattern: str = "*.parquet"
    execution_date: str | None = None
    # move finished files out of the landing area (keeps the listing bounded)
    archive_dir: str | None = None
    quarantine_files_dir: str | None = None
    # fold the ledger log into a snapshot once it spans more than this many days
    compact_after_days: int | None = 7
    # schema of the dimension table (as returned by ``bootstrap``): saves schema inference per batch
    dimension_schema: T.StructType | None = None
    # list only the landing folders that may hold new files (see ``sources.cursor``), not all of them
    folder_cursor: bool = False
    # probe only the enriched batch folders whose recorded key range overlaps the increment's
    prune_target: bool = True
    # keep a Bloom filter of each batch's inserted keys and probe only folders whose filter hits
    key_index: bool = True
    key_index_min_rows: int = MIN_ROWS  # smaller folders are probed without one

    @property
    def ledger_path(self) -> str:
        return f"{self.root}/ledger"

    @property
    def audit_path(self) -> str:
        return f"{self.root}/audit"

    @property
    def cursor_path(self) -> str:
        return f"{self.root}/landing_cursor"

    @property
    def key_index_path(self) -> str:
        return f"{self.root}/key_index"

    @property
    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def stream_checkpoint(self) -> str:
        return f"{self.root}/_stream_checkpoint"

    def raw_table(self) -> Table:
        return Table(f"{self.root}/raw", RAW_SCHEMA, PARTS)

    def dimension_table(self, schema: T.StructType) -> Table:
        return Table(f"{self.root}/dimension", schema)

    def enriched_table(self, dim_schema: T.StructType) -> Table:
        return Table(f"{self.root}/enriched", enriched_schema(dim_schema, self.dim_key), PARTS)


@dataclass(frozen=True)
class BatchResult:
    status: str  # "empty" | "loaded" | "quarantined"
    batch_id: str | None = None
    batch_time: datetime | None = None
    paths: tuple[str, ...] = ()
    summary: dict | None = None
    results: tuple[Row, ...] = ()
    inserted: int | None = None


def batch_id_for(batch_time: datetime) -> str:
    """Sortable text of the stamp (orders like the stamp itself)."""
    return batch_time.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


def _utc(dt: datetime) -> datetime:
    return dt.astimezone(timezone.utc)  # naive values (as collected) are local time


def to_raw(batch: DataFrame, batch_time: datetime) -> DataFrame:
    """Epoch -> TIMESTAMP, one ingest stamp for the whole batch, raw column order."""
    out = batch.withColumns({
        "orderdate": epoch_to_timestamp("orderdate"),
        "processed_date": F.lit(_utc(batch_time)).cast("timestamp"),
    })
    return out.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMA.fields])


def bootstrap(spark: SparkSession, cfg: PipelineConfig, dimension: DataFrame) -> tuple[Table, Table, Table]:
    """One-off setup (idempotent): raw and enriched tables, dimension (overwritten)."""
    dim = overwrite(spark, cfg.dimension_table(dimension.schema), dimension)
    raw = create_table(spark, cfg.raw_table())
    enriched = create_table(spark, cfg.enriched_table(dim.schema))
    return raw, dim, enriched


def _dimension(spark: SparkSession, cfg: PipelineConfig) -> tuple[DataFrame, T.StructType]:
    reader = spark.read.schema(cfg.dimension_schema) if cfg.dimension_schema is not None else spark.read
    dim = reader.parquet(f"{cfg.root}/dimension")
    return dim, dim.schema


def _stamp(summary: LedgerSummary, wanted: datetime | None) -> datetime:
    """Stamps must strictly increase across batches and lie above the mark (strict ``>`` in the
    increment; a backfill may have raised the mark beyond the last batch's stamp)."""
    last = None if summary.last_batch_time is None else _utc(summary.last_batch_time)
    if summary.watermark_us is not None:
        mark = datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=summary.watermark_us)
        last = mark if last is None else max(last, mark)
    if wanted is not None:
        wanted = _utc(wanted)
        if last is not None and wanted <= last:
            raise ValueError(f"batch time {wanted} is not after the last batch time {last}")
        return wanted
    now = datetime.now(timezone.utc)
    return now if last is None or now > last else last + timedelta(milliseconds=1)


def run_batch(spark: SparkSession, cfg: PipelineConfig, batch_time: datetime | None = None) -> BatchResult:
    """Process the next batch of landing files (or resume the pending one)."""
    if cfg.compact_after_days and log_days_since_snapshot(spark, cfg.ledger_path) > cfg.compact_after_days:
        compact_ledger(spark, cfg.ledger_path)
    ledger = read_ledger(spark, cfg.ledger_path)
    summary = summarise_ledger(ledger)
    if summary.pending:
        batch_id, stamp = summary.last_batch_id, _utc(summary.last_batch_time)
        files = batch_paths(ledger, batch_id)
    else:
        if cfg.folder_cursor:
            found = next_files(spark, cfg.landing, ledger, read_cursor(spark, cfg.cursor_path), cfg.max_files, cfg.pattern)
            advance_cursor(spark, cfg.cursor_path, found.finished)  # folders the ledger holds already
            files = found.files
        else:
            listing = list_files(spark, cfg.landing, cfg.pattern)
            files = [(r["path"], r["version"]) for r in next_batch(listing, ledger, cfg.max_files).collect()]
        if not files:
            return BatchResult("empty")
        stamp = _stamp(summary, batch_time)
        batch_id = batch_id_for(stamp)
        record(spark, cfg.ledger_path, files, batch_id, stamp, "pending")
    return process_batch(spark, cfg, read_landing(spark, names_of(files)), batch_id, stamp, files, summary, ledger)


def process_batch(spark: SparkSession, cfg: PipelineConfig, batch: DataFrame, batch_id: str,
                  batch_time: datetime, files, summary: LedgerSummary | None = None,
                  ledger: DataFrame | None = None) -> BatchResult:
    """Validate, gate and load one batch whose ledger rows are already ``pending``.

    ``files`` are the batch's paths or (path, version) pairs; ``ledger`` and ``summary`` are
    the ledger and its state read before this batch was started (or resumed): what it says
    of the earlier batches no longer changes.
    """
    paths = names_of(files)
    if ledger is None:
        ledger = read_ledger(spark, cfg.ledger_path)
    if summary is None:
        summary = summarise_ledger(ledger)
    known = ledger  # what is known of each batch folder
    journal = read_journal(spark, cfg.root)
    if journal is not None:
        finish_compactions(spark, cfg.root, journal)  # no table is read with both old and packed folders
        known = ledger.unionByName(as_ledger_rows(journal))
    readable = not schema_faults(spark, paths)  # broken footers, missing or extra columns, other types
    if readable:
        results, quality = run_suite(derive_check_columns(batch), list(cfg.suite))  # one scan
    else:
        results, quality = [], {"success": False, "total_expectations": len(cfg.suite), "passed_expectations": 0,
                                "failed_expectations": len(cfg.suite), "pass_rate": 0.0, "record_count": None}
    decision = gate(quality, cfg.min_pass_rate, cfg.min_records)
    execution_date = cfg.execution_date or batch_time.strftime("%Y-%m-%d")
    write_audit(audit_frame(spark, quality, execution_date, batch_id, decision), cfg.audit_path, batch_id,
                execution_date)

    if decision != "load":
        # K4: a copy of the batch for inspection; the folder is the batch's own, so a replay overwrites it.
        if readable:
            batch.write.mode("overwrite").parquet(f"{cfg.quarantine_path}/{BATCH_COL}={batch_id}")
        record(spark, cfg.ledger_path, files, batch_id, batch_time, "quarantined")
        if cfg.quarantine_files_dir:
            move_files(spark, paths, cfg.landing, cfg.quarantine_files_dir)
        return BatchResult("quarantined", batch_id, batch_time, tuple(paths), quality, tuple(results))

    raw_t = cfg.raw_table()
    append(raw_t, to_raw(batch, batch_time), batch_id, cluster="local")

    dim, dim_schema = _dimension(spark, cfg)
    enr_t = cfg.enriched_table(dim_schema)
    target = None  # reading the whole table lists all its files: only where nothing narrower will do
    mark = summary.watermark_us  # pending batches carry no mark: this is the target without this batch
    if mark is None and summary.merged == 0:
        target = read_table(spark, enr_t, exclude_batch=batch_id)
        mark = high_water_mark(target)  # first merge: the table may hold rows from elsewhere
    if summary.merged == 0:
        # first merge: the whole raw table above the mark (folders pruned by batch id)
        min_batch = batch_id_for(datetime.fromtimestamp(mark / 1e6, timezone.utc)) if mark is not None else None
        raw_rows = read_table(spark, raw_t, keep_hidden=True)
    else:
        # Raw folders of merged batches hold nothing that a merge has not seen, and the enriched
        # table only grows. What is left: this batch's own folder and folders that the ledger does
        # not record as merged (a backfill written by another job). They are read by path: only
        # folder names of the raw table are listed.
        min_batch = None
        folders = [n.split("=", 1)[1] for n, is_dir in child_entries(spark, raw_t.path)
                   if is_dir and n.startswith(f"{BATCH_COL}=")]
        raw_rows = read_batches(spark, raw_t, unmerged_batches(spark, known, folders),
                                keep_hidden=True)
    new = increment(raw_rows, mark, "processed_date", batch_col=BATCH_COL, min_batch=min_batch)
    enriched_new = enrich(new.select(*raw_t.columns), dim, cfg.fact_key, cfg.dim_key)
    size = source_key_size(new, cfg.key)  # enrichment keeps rows and keys: no need to join for their size
    integral = isinstance(enr_t.schema[cfg.key].dataType, T.IntegralType)
    if cfg.prune_target and summary.merged > 0 and size.key_min is not None:
        key_range = (int(size.key_min), int(size.key_max)) if integral else (None, None)
        small = fits_broadcast(size, broadcast_threshold(spark) or 50 * 1024 * 1024)
        probe = probe_target(spark, enr_t, known, batch_id, *key_range, index=cfg.key_index_path,
                             keys=new.select(cfg.key) if cfg.key_index and small else None, rows=size.rows)
        if probe is not None:
            target = probe
    if target is None:
        target = read_table(spark, enr_t, exclude_batch=batch_id)
    to_insert = merge_insert(target, enriched_new, cfg.key, size=size)
    # metrics of the rows actually written, gathered by the write job itself
    obs = Observation(f"insert_{batch_id}")
    metrics = [F.count(F.lit(1)).alias("n"),
               timestamp_to_micros(F.max("processed_date"), T.TimestampType()).alias("m")]
    if integral:
        metrics += [F.min(cfg.key).cast("long").alias("kmin"), F.max(cfg.key).cast("long").alias("kmax")]
    to_insert = to_insert.observe(obs, *metrics)
    append(enr_t, to_insert, batch_id, cluster="local")
    got = obs.get
    new_mark = max([m for m in (mark, got.get("m")) if m is not None], default=None)
    key_range = None
    if integral:  # (1, 0): tracked, no non-NULL key inserted
        key_range = (got["kmin"], got["kmax"]) if got.get("kmin") is not None else (1, 0)
    blocks = None
    if cfg.key_index and int(got["n"]) >= cfg.key_index_min_rows:  # before the ledger says so: a folder without a recorded index is always probed
        blocks = write_index(read_batch(spark, enr_t, batch_id), cfg.key, int(got["n"]),
                             f"{cfg.key_index_path}/{BATCH_COL}={batch_id}")
    record(spark, cfg.ledger_path, files, batch_id, batch_time, ("loaded", "archived"), watermark_us=new_mark,
           key_range=key_range, key_blocks=blocks)
    if cfg.archive_dir:
        move_files(spark, paths, cfg.landing, cfg.archive_dir)
    return BatchResult("loaded", batch_id, batch_time, tuple(paths), quality, tuple(results), int(got["n"]))


def probe_target(spark: SparkSession, table: Table, ledger: DataFrame, exclude_batch: str, lo: int | None,
                 hi: int | None, index: str | None = None, keys: DataFrame | None = None,
                 rows: int | None = None) -> DataFrame | None:
    """The part of the enriched table that can hold keys in ``[lo, hi]``, or None (read it all).

    Every batch folder except the current one is kept unless the ledger recorded the key
    range that batch inserted and the range misses ``[lo, hi]``, or its key index (below
    ``index``) holds none of ``keys`` (a small frame of one column). Folders the ledger does
    not know (rows loaded another way, upsert folders) are kept. Data files outside
    ``batch_id=`` folders make the layout unknown: None.
    """
    entries = [(n, d) for n, d in child_entries(spark, table.path) if not n.startswith(("_", "."))]
    if any(not d or not n.startswith(f"{BATCH_COL}=") for n, d in entries):
        return None
    folders = [n.split("=", 1)[1] for n, _ in entries]
    near = batches_to_probe(spark, ledger, [f for f in folders if f != exclude_batch], lo, hi)
    if keys is not None:
        indexed = {f: n for f, n in near.items() if n is not None}
        hit = set(folders_that_may_hold(spark, index, indexed, keys, keys.columns[0], BATCH_COL, rows))
        near = {f: n for f, n in near.items() if n is None or f in hit}
    return read_batches(spark, table, sorted(near))


def tidy_landing(spark: SparkSession, cfg: PipelineConfig, max_moves: int = 1000) -> int:
    """Finish moves interrupted by a crash: all files still in the landing area whose ledger
    state is already archived/quarantined are moved, ``max_moves`` at a time."""
    where = {s: d for s, d in (("archived", cfg.archive_dir), ("quarantined", cfg.quarantine_files_dir)) if d}
    moved = 0
    while where:
        listing = list_files(spark, cfg.landing, cfg.pattern).select("path", "version")
        done = (current_state(read_ledger(spark, cfg.ledger_path))
                .filter(F.col("state").isin(list(where))).select("path", "version", "state"))
        left = listing.join(done, ["path", "version"], "inner").limit(max_moves).collect()
        if not left:
            break
        for state, dest in where.items():
            moved += len(move_files(spark, [r["path"] for r in left if r["state"] == state], cfg.landing, dest))
    return moved


def run_all(spark: SparkSession, cfg: PipelineConfig, clock=None, max_batches: int | None = None) -> list[BatchResult]:
    """Run batches until the landing area has nothing new. ``clock(i)`` gives batch i's stamp."""
    out: list[BatchResult] = []
    i = 0
    while max_batches is None or i < max_batches:
        res = run_batch(spark, cfg, clock(i) if clock else None)
        if res.status == "empty":
            break
        out.append(res)
        i += 1
    return out
