"""Streaming ingest of the landing folder (R2).

The stream watches file names and times only (``binaryFile`` without content) with
``maxFilesPerTrigger`` = batch size; each micro-batch hands its files to the same
validate/gate/load/merge step as the batch pipeline, through ``foreachBatch``. So files
that cannot be read, or hold no rows, are treated alike in both.

The ledger decides what is done: files it has finished are left out, a batch it has
pending is finished first, with its own files and stamp, and the rest of the micro-batch
becomes a new batch. A replay after a failure therefore neither loses nor repeats a file,
nor does a stream that starts over a folder which batches have worked on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ledger import (batch_paths, current_state, names_of, read_ledger, record, summarise_ledger)
from tidemark.plans.runner import PipelineConfig, _stamp, _utc, batch_id_for, process_batch
from tidemark.sources.files import read_landing

# The columns of the file source that lists files.
FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("modificationTime", T.TimestampType()),
    T.StructField("length", T.LongType()), T.StructField("content", T.BinaryType())])


def ingest_stream(spark: SparkSession, cfg: PipelineConfig, clock=None, available_now: bool = True,
                  processing_time: str | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it drains the folder and stops."""
    reader = (spark.readStream.format("binaryFile").schema(FILE_SCHEMA)
              .option("maxFilesPerTrigger", cfg.max_files)
              .option("pathGlobFilter", cfg.pattern)
              .option("recursiveFileLookup", "true"))  # same files as the batch listing
    if cfg.archive_dir or cfg.quarantine_files_dir:
        # a replayed micro-batch may name files that were moved meanwhile: the ledger has
        # them in a final state, so there is nothing left to do for them
        reader = reader.option("ignoreMissingFiles", "true")
    source = reader.load(cfg.landing).select("path", F.unix_millis("modificationTime").alias("version"))

    def handle(batch: DataFrame, epoch_id: int) -> None:
        # at most max_files names per micro-batch
        files = sorted((r["path"], r["version"]) for r in batch.distinct().collect())
        if not files:
            return
        ledger = read_ledger(spark, cfg.ledger_path)
        summary = summarise_ledger(ledger)
        if summary.pending:
            batch_id, stamp = summary.last_batch_id, _utc(summary.last_batch_time)
            pending = batch_paths(ledger, batch_id)
            process_batch(spark, cfg, read_landing(spark, names_of(pending)), batch_id, stamp, pending, summary,
                          ledger)
            ledger = read_ledger(spark, cfg.ledger_path)
            summary = summarise_ledger(ledger)
        known = current_state(ledger.filter(F.col("path").isin(names_of(files)))).select("path", "version")
        done = {(r["path"], r["version"]) for r in known.collect()}
        fresh = [f for f in files if f not in done]
        if not fresh:
            return
        stamp = _stamp(summary, clock(epoch_id) if clock else None)
        batch_id = batch_id_for(stamp)
        record(spark, cfg.ledger_path, fresh, batch_id, stamp, "pending")
        process_batch(spark, cfg, read_landing(spark, names_of(fresh)), batch_id, stamp, fresh, summary, ledger)

    writer = (source.writeStream.foreachBatch(handle)
              .option("checkpointLocation", cfg.stream_checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_stream_to_end(spark: SparkSession, cfg: PipelineConfig, clock=None) -> None:
    q = ingest_stream(spark, cfg, clock=clock, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


__all__ = ["ingest_stream", "run_stream_to_end"]
