"""Runtime settings and the shared scratch location.

The library never builds or stops a session. ``profile`` only sets runtime SQL
settings; ``scratch_path`` derives every intermediate location from the
cluster's ``spark.checkpoint.dir`` so that staged tables live on shared storage.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# The original job settings (50 MB broadcast threshold, AQE on,
# 24 shuffle partitions intended).
BROADCAST_THRESHOLD = 50 * 1024 * 1024
MIN_SHUFFLE_PARTITIONS = 24

DEFAULT_PROFILE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_THRESHOLD),
    "spark.sql.session.timeZone": "UTC",
}


def profile(spark: SparkSession, **overrides: str) -> dict[str, str]:
    """Apply the runtime profile (R6) and return what was set.

    Shuffle partitions start at three per core of the cluster (never below the
    original 24) and AQE coalesces them to ~128 MB, so the same setting fits an
    hourly batch and a backfill. Keys may be given with dots replaced by
    underscores, e.g. ``profile(spark, spark_sql_shuffle_partitions="400")``.
    Writer behaviour (e.g. dynamic partition overwrite) is set per write by the
    library, never session-wide.
    """
    settings = dict(DEFAULT_PROFILE)
    cores = spark.sparkContext.defaultParallelism
    settings["spark.sql.shuffle.partitions"] = str(max(MIN_SHUFFLE_PARTITIONS, 3 * cores))
    for k, v in overrides.items():
        settings[k.replace("_", ".") if not k.startswith("spark.") else k] = str(v)
    for k, v in settings.items():
        spark.conf.set(k, v)
    return settings


def ensure_utc(spark: SparkSession) -> None:
    """Validation formats instants in the session zone; pin it to UTC."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def broadcast_threshold(spark: SparkSession) -> int:
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        value = int(str(raw).lower().removesuffix("b"))
    except ValueError:
        value = 10 * 1024 * 1024
    return value if value > 0 else 0


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when the setting is absent and the master is local (tests) a private
    folder is created and registered with ``setCheckpointDir`` (the core setting
    itself cannot be changed at run time). On a cluster a missing setting is an
    error: a machine-local folder would lose what other executors write.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        root = sc.getCheckpointDir()
    if not root and not re.fullmatch(r"local(\[.*\])?", sc.master or ""):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if not root:
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
        root = sc.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location below the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
