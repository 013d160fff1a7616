"""Command-line entry point for scheduled runs (``spark-submit tidemark/cli.py <command> ...``).

Commands:
  bootstrap       create raw / enriched tables, load the dimension from CSV (optionally rolled up)
  run-batch       process the next batch of landing files (or resume the pending one)
  run-all         process batches until the landing area has nothing new
  stream          the same through Structured Streaming (availableNow, or a processing-time trigger)
  compact-ledger  fold old ledger days into a snapshot
  tidy-landing    finish archive/quarantine moves interrupted by a crash
  compact-lake    pack small batch folders of the raw and enriched table in place

The application owns its session: built here (with the library profile applied)
unless one is passed to ``main``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _config(args):
    from tidemark.plans.runner import PipelineConfig
    from tidemark.operators.quality import default_suite

    suite = tuple(default_suite(row_count=(args.min_rows, args.max_rows), years=(args.min_year, args.max_year)))
    return PipelineConfig(landing=args.landing, root=args.root, max_files=args.max_files, suite=suite,
                          min_pass_rate=args.min_pass_rate, min_records=args.min_records,
                          archive_dir=args.archive_dir, quarantine_files_dir=args.quarantine_files_dir)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("bootstrap", "run-batch", "run-all", "stream", "compact-ledger", "tidy-landing", "compact-lake"):
        s = sub.add_parser(name)
        s.add_argument("--landing", required=not name.startswith("compact-"), default=None)
        s.add_argument("--root", required=True, help="folder of raw/enriched/ledger/audit/quarantine")
        s.add_argument("--max-files", type=int, default=5)
        s.add_argument("--min-rows", type=int, default=500)
        s.add_argument("--max-rows", type=int, default=500)
        s.add_argument("--min-year", type=int, default=2020)
        s.add_argument("--max-year", type=int, default=2025)
        s.add_argument("--min-pass-rate", type=float, default=100.0)
        s.add_argument("--min-records", type=int, default=500)
        s.add_argument("--archive-dir", default=None)
        s.add_argument("--quarantine-files-dir", default=None)
        if name == "bootstrap":
            s.add_argument("--dimension-csv", required=True)
            s.add_argument("--rollup-key", default=None,
                           help="county-level CSV: roll up by this key column first (sums, Income* means)")
        if name == "stream":
            s.add_argument("--processing-time", default=None, help="e.g. '1 hour'; default: availableNow")
        if name not in ("compact-ledger", "compact-lake"):
            s.add_argument("--folder-cursor", action="store_true", help="list only landing folders that may hold new files")
        if name == "compact-lake":
            s.add_argument("--target-bytes", type=int, default=512 << 20)
        if name == "compact-ledger":
            s.add_argument("--upto", default=None, help="yyyy-mm-dd (default: today, UTC)")
            s.add_argument("--purge", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    own = spark is None
    if own:
        from tidemark.session import profile

        spark = SparkSession.builder.appName(f"tidemark-{args.command}").getOrCreate()
        profile(spark)
    try:
        return _run(spark, args)
    finally:
        if own:
            spark.stop()


def _run(spark: SparkSession, args) -> dict:
    from tidemark.operators.ledger import compact_ledger
    from tidemark.plans.runner import bootstrap, run_all, run_batch, tidy_landing
    from tidemark.streaming.ingest import ingest_stream

    if args.command == "compact-ledger":
        return {"snapshot": compact_ledger(spark, f"{args.root}/ledger", args.upto, args.purge)}
    cfg = _config(args)
    if args.command == "bootstrap":
        from tidemark.operators.rollup import rollup_dimension
        from tidemark.sources.csv import read_csv_inferred, widen_integers

        dim = read_csv_inferred(spark, args.dimension_csv)
        dim = rollup_dimension(dim, key=args.rollup_key) if args.rollup_key else widen_integers(dim)
        raw, d, enriched = bootstrap(spark, cfg, dim)
        return {"raw": raw.path, "dimension": d.path, "enriched": enriched.path}
    if args.command == "run-batch":
        r = run_batch(spark, cfg)
        return {"status": r.status, "batch_id": r.batch_id, "files": len(r.paths), "inserted": r.inserted,
                "summary": r.summary}
    if args.command == "compact-lake":
        from tidemark.plans.compaction import compact_lake

        packed = compact_lake(spark, cfg, args.target_bytes)
        return {name: [{"batch_id": p.batch_id, "folders": len(p.folders)} for p in ps] for name, ps in packed.items()}
    if args.command == "tidy-landing":
        return {"moved": tidy_landing(spark, cfg)}
    if args.command == "run-all":
        return {"batches": [{"status": r.status, "batch_id": r.batch_id, "inserted": r.inserted}
                            for r in run_all(spark, cfg)]}
    q = ingest_stream(spark, cfg, available_now=args.processing_time is None, processing_time=args.processing_time)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return {"stream": "done"}


if __name__ == "__main__":
    print(json.dumps(main(sys.argv[1:]), default=str))
