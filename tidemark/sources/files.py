"""Landing-area sources."""

from __future__ import annotations

from py4j.protocol import Py4JError, Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import LANDING_SCHEMA


def list_files(spark: SparkSession, folder: str, pattern: str = "*.parquet", recursive: bool = True) -> DataFrame:
    """``(path, length, modificationTime, version)`` of every matching file below ``folder``.

    ``version`` is the modification time in ms: with the path it identifies a
    delivery, so a file written again under the same name is picked again.
    ``binaryFile`` with only metadata columns selected never reads file content.
    A missing folder lists as empty.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        return reader.load(folder).select("path", "length", "modificationTime",
                                          F.unix_millis("modificationTime").alias("version"))
    except Exception as exc:
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
            schema = T.StructType([T.StructField("path", T.StringType()),
                                   T.StructField("length", T.LongType()),
                                   T.StructField("modificationTime", T.TimestampType()),
                                   T.StructField("version", T.LongType())])
            return spark.createDataFrame([], schema)
        raise


def write_manifest(paths: DataFrame, manifest_dir: str, path_col: str = "path") -> None:
    """K8: one path per line (a batch is at most ``max_files`` lines, so one task)."""
    paths.select(F.col(path_col).alias("value")).coalesce(1).write.mode("overwrite").text(manifest_dir)


def read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    """S2 + F5: manifest lines as ``path``, trimmed, blank lines dropped."""
    return (spark.read.text(manifest)
            .select(F.trim("value").alias("path"))
            .filter(F.length("path") > 0))


def manifest_paths(manifest: DataFrame, max_files: int, path_col: str = "path") -> list[str]:
    """S3: the batch's paths on the driver; refuses more than ``max_files``."""
    rows = manifest.select(path_col).limit(max_files + 1).collect()
    if len(rows) > max_files:
        raise ValueError(f"manifest lists more than {max_files} files")
    return [r[0] for r in rows]


_NO_FOOTER = {"FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER", "UNABLE_TO_INFER_SCHEMA"}


def error_conditions(exc: Exception) -> set[str]:
    """Spark's error conditions of an exception and its causes."""
    if isinstance(exc, PySparkException):
        return {exc.getCondition()} - {None}
    found, cause = set(), exc.java_exception
    while cause is not None:
        try:
            found.add(cause.getCondition())
        except Py4JError:  # not an exception of Spark's own
            pass
        cause = cause.getCause()
    return found - {None}


def schema_faults(spark: SparkSession, paths: list[str], schema: T.StructType = LANDING_SCHEMA) -> list[str]:
    """What is wrong with the columns of each file: names by name, types by type (one footer
    read per file of a batch). A read with a declared schema would make a missing column NULL
    and ignore an extra one."""
    want = {f.name: f.dataType for f in schema.fields}
    faults = []
    for p in paths:
        try:
            have = {f.name: f.dataType for f in spark.read.parquet(p).schema.fields}
        except (Py4JJavaError, PySparkException) as exc:
            if not error_conditions(exc) & _NO_FOOTER:
                raise  # a file system that does not answer, say: the batch stays pending and is retried
            faults.append(f"{p}: no readable footer")
            continue
        for c in sorted(set(want) | set(have)):
            if have.get(c) != want.get(c):
                faults.append(f"{p}: {c} is {have.get(c)}, not {want.get(c)}")
    return faults


def read_landing(spark: SparkSession, paths: list[str], schema: T.StructType = LANDING_SCHEMA) -> DataFrame:
    """One scan over all batch files with the declared schema (no footer inference)."""
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)
