"""Column-level helpers (P1-P6, P9, P18, month clustering key). All built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import normalise_name

_EPOCH_NTZ = "1970-01-01 00:00:00"


def _epoch_ntz() -> Column:
    return F.lit(_EPOCH_NTZ).cast("timestamp_ntz")


def epoch_to_timestamp(col: str | Column) -> Column:
    """Unix epoch seconds -> TIMESTAMP (an instant). NULL stays NULL."""
    return F.timestamp_seconds(F.col(col) if isinstance(col, str) else col)


def epoch_to_timestamp_ntz(col: str | Column) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ holding the UTC wall clock (no session-zone dependence)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.timestamp_add("SECOND", c, _epoch_ntz())


def timestamp_to_epoch(col: str | Column) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ -> epoch seconds (NTZ is read as UTC wall clock)."""
    return F.unix_timestamp(F.col(col) if isinstance(col, str) else col)


def timestamp_to_micros(col: str | Column, dtype: T.DataType) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", _epoch_ntz(), c)
    return F.unix_micros(c)


def micros_to_timestamp(micros: int, dtype: T.DataType) -> Column:
    """Literal instant of the given type; folds to a constant, so it reaches parquet pushdown."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_add("MICROSECOND", F.lit(int(micros)), _epoch_ntz())
    return F.timestamp_micros(F.lit(int(micros)))


def month_index(col: str | Column) -> Column:
    """Months since 1970-01 (the ``months()`` partition transform): 0 = 1970-01."""
    c = F.col(col) if isinstance(col, str) else col
    return ((F.year(c) - 1970) * 12 + F.month(c) - 1).cast("int")


def derive_check_columns(df: DataFrame, epoch_col: str = "orderdate") -> DataFrame:
    """The derived columns the quality suite checks.

    ``orderdate`` becomes the session-zone text of the epoch, and three parts
    are derived from it: date text, time text and year.
    """
    text = F.from_unixtime(F.col(epoch_col))
    return df.withColumns({
        epoch_col: text,
        f"{epoch_col}_date": F.date_format(text, "yyyy-MM-dd"),
        f"{epoch_col}_time": F.date_format(text, "HH:mm:ss"),
        f"{epoch_col}_year": F.year(text),
    })


def normalise_names(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Rename every column with dots, spaces or hyphens; explicit ``mapping`` wins."""
    mapping = mapping or {}
    return df.select(*[F.col(f"`{c}`").alias(mapping.get(c, normalise_name(c))) for c in df.columns])


def strip_scheme(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, r"^[A-Za-z][A-Za-z0-9+.\-]*://", "")


def path_basename(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.substring_index(c, "/", -1)


def literal_rows(spark, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A small frame of literal rows planned entirely in the JVM (no Python worker).

    Meant for bounded bookkeeping rows (ledger states, audit records).
    """
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, schema.fields)])
               for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))  # one row, one partition
