"""Event-time de-duplication of a stream (R2), before its rows reach the merge.

The first arrival of a key is passed on and remembered in keyed state until the watermark
(the greatest event time seen, less ``delay``) has passed its event time by ``delay``. Rows
older than the watermark are late and dropped: without that bound the state would grow for
ever. State is partitioned by key and kept in the stream's checkpoint, so a lost executor or
a restarted query forgets nothing; a key that repeats very often costs one state row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def first_arrivals(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """``stream`` without repeated keys (within the watermark) and without late rows.

    NULL keys count as one key. A row without event time is never late.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def drain_unique(spark: SparkSession, landing: str, schema: T.StructType, out: str, checkpoint: str,
                 keys: list[str], event_time: str, delay: str, max_files: int | None = None) -> None:
    """Appends the first arrivals of all new files below ``landing`` to ``out``, then stops.

    Runs with the same ``checkpoint`` go on where the last one ended, with its state and
    watermark; the file sink commits each micro-batch once.
    """
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (first_arrivals(reader.parquet(landing), keys, event_time, delay).writeStream
             .format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
