"""Batch quality checks.

All expectations of a suite are evaluated by ONE aggregate over the batch
(one file scan); its single row is exploded into one result row per
expectation. Column checks ignore NULLs except ``NotNull``. ``count_if``
is used so that an empty batch gives 0 unexpected rows, not NULL.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import literal_rows
from tidemark.schemas import (AUDIT_SCHEMA, DATE_REGEX, DEFAULT_MIN_PASS_RATE, DEFAULT_MIN_RECORDS,
                              DEFAULT_ROW_COUNT, DEFAULT_YEAR_RANGE)


@dataclass(frozen=True)
class RowCountBetween:
    min_value: int | None = None
    max_value: int | None = None
    kind = "expect_table_row_count_to_be_between"
    column = None

    def unexpected(self) -> Column | None:
        return None

    def success(self, rows: Column, unexpected: Column | None) -> Column:
        ok = F.lit(True)
        if self.min_value is not None:
            ok = ok & (rows >= F.lit(self.min_value))
        if self.max_value is not None:
            ok = ok & (rows <= F.lit(self.max_value))
        return ok


@dataclass(frozen=True)
class NotNull:
    column: str
    kind = "expect_column_values_to_not_be_null"

    def violation(self) -> Column:
        return F.col(self.column).isNull()

    def unexpected(self) -> Column:
        return F.count_if(self.violation())

    def success(self, rows: Column, unexpected: Column) -> Column:
        return unexpected == 0


@dataclass(frozen=True)
class MatchRegex:
    column: str
    regex: str
    kind = "expect_column_values_to_match_regex"

    def violation(self) -> Column:
        c = F.col(self.column)
        return c.isNotNull() & ~c.rlike(self.regex)

    def unexpected(self) -> Column:
        return F.count_if(self.violation())

    def success(self, rows: Column, unexpected: Column) -> Column:
        return unexpected == 0


@dataclass(frozen=True)
class Between:
    column: str
    min_value: float | int | None = None
    max_value: float | int | None = None
    kind = "expect_column_values_to_be_between"

    def violation(self) -> Column:
        c = F.col(self.column)
        bad = F.lit(False)
        if self.min_value is not None:
            bad = bad | (c < F.lit(self.min_value))
        if self.max_value is not None:
            bad = bad | (c > F.lit(self.max_value))
        return c.isNotNull() & bad

    def unexpected(self) -> Column:
        return F.count_if(self.violation())

    def success(self, rows: Column, unexpected: Column) -> Column:
        return unexpected == 0


Expectation = RowCountBetween | NotNull | MatchRegex | Between


def default_suite(row_count: tuple[int, int] = DEFAULT_ROW_COUNT,
                  years: tuple[int, int] = DEFAULT_YEAR_RANGE, key: str = "invoiceid",
                  date_col: str = "orderdate") -> list[Expectation]:
    """The four checks of the original batch suite (over ``derive_check_columns`` output)."""
    return [
        RowCountBetween(*row_count),
        NotNull(key),
        MatchRegex(f"{date_col}_date", DATE_REGEX),
        Between(f"{date_col}_year", *years),
    ]


def validate(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One result row per expectation: expectation, column_name, observed, unexpected_count, success, record_count.

    ``observed`` is the row count for the table check and the unexpected
    count for column checks. Lazy; a single scan when executed.
    """
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, e in enumerate(suite):
        u = e.unexpected()
        if u is not None:
            aggs.append(u.alias(f"__u{i}"))
    one = df.agg(*aggs)
    rows = F.col("__rows")
    structs = []
    for i, e in enumerate(suite):
        u = F.col(f"__u{i}") if e.unexpected() is not None else None
        observed = (rows if u is None else u).cast("double")
        structs.append(F.struct(
            F.lit(i).alias("idx"),
            F.lit(e.kind).alias("expectation"),
            F.lit(e.column).cast("string").alias("column_name"),
            observed.alias("observed"),
            (u if u is not None else F.lit(0)).cast("long").alias("unexpected_count"),
            e.success(rows, u).alias("success"),
            rows.cast("long").alias("record_count"),
        ))
    return one.select(F.inline(F.array(*structs)))


def unexpected_samples(df: DataFrame, suite: list[Expectation], key: str, size: int = 8) -> DataFrame:
    """``validate`` with examples: per column check up to ``size`` violating rows, as (key, value).

    The examples come out of the same aggregate and scan. A row's hash (of its key) puts it
    into one of ``size`` slots, and each slot keeps the violating row of the least hash: a
    uniform, repeatable sample in bounded memory, however many rows violate. Rows are hashed
    only if they violate. NULL keys are hashed as an empty text.
    """
    k = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))
    h = F.conv(F.substring(F.md5(k.cast("binary")), 1, 15), 16, 10).cast("long")
    aggs, checks = [F.count(F.lit(1)).alias("__rows")], []
    for i, e in enumerate(suite):
        if e.column is None:
            continue
        bad, checks = e.violation(), [*checks, (i, e)]
        example = F.struct(h.alias("h"), k.alias("key"), F.col(e.column).cast("string").alias("value"))
        aggs.append(e.unexpected().alias(f"__u{i}"))
        aggs += [F.min(F.when(bad, F.when(h % size == s, example))).alias(f"__s{i}_{s}") for s in range(size)]
    one = df.agg(*aggs)
    structs = []
    for i, e in checks:
        found = F.array_compact(F.array(*[F.col(f"__s{i}_{s}") for s in range(size)]))
        structs.append(F.struct(
            F.lit(i).alias("idx"), F.lit(e.kind).alias("expectation"), F.lit(e.column).alias("column_name"),
            F.col(f"__u{i}").cast("long").alias("unexpected_count"),
            F.transform(F.array_sort(found), lambda x: F.struct(x["key"].alias("key"), x["value"].alias("value"))).alias("examples")))
    return one.select(F.inline(F.array(*structs)))


def summarise(results: DataFrame) -> DataFrame:
    """One row: success, total/passed/failed expectations, pass_rate (%), record_count.

    An empty suite has a NULL pass rate (the gate then refuses the batch).
    """
    total = F.count(F.lit(1))
    passed = F.count_if(F.col("success"))
    return results.agg(
        (F.count_if(~F.col("success")) == 0).alias("success"),
        total.cast("long").alias("total_expectations"),
        passed.cast("long").alias("passed_expectations"),
        (total - passed).cast("long").alias("failed_expectations"),
        F.when(total > 0, passed * F.lit(100.0) / total).alias("pass_rate"),
        F.max("record_count").cast("long").alias("record_count"),
    )


def decision_column(pass_rate: Column, record_count: Column,
                    min_pass_rate: float = DEFAULT_MIN_PASS_RATE,
                    min_records: int = DEFAULT_MIN_RECORDS) -> Column:
    ok = (pass_rate >= F.lit(float(min_pass_rate))) & (record_count >= F.lit(int(min_records)))
    return F.when(F.coalesce(ok, F.lit(False)), F.lit("load")).otherwise(F.lit("quarantine"))


def gate(summary: Row | dict, min_pass_rate: float = DEFAULT_MIN_PASS_RATE,
         min_records: int = DEFAULT_MIN_RECORDS) -> str:
    """Q7: ``"load"`` when pass rate and record count reach the thresholds, else ``"quarantine"``."""
    s = summary.asDict() if isinstance(summary, Row) else dict(summary)
    rate, rows = s.get("pass_rate"), s.get("record_count")
    if rate is None or rows is None:
        return "quarantine"
    return "load" if rate >= min_pass_rate and rows >= min_records else "quarantine"


def run_suite(df: DataFrame, suite: list[Expectation]) -> tuple[list[Row], dict]:
    """Evaluate the suite with one scan and bring the (tiny) results to the driver."""
    results = validate(df, suite).collect()
    total = len(results)
    passed = sum(1 for r in results if r["success"])
    record_count = results[0]["record_count"] if results else None
    summary = {
        "success": passed == total,
        "total_expectations": total,
        "passed_expectations": passed,
        "failed_expectations": total - passed,
        "pass_rate": (passed * 100.0 / total) if total else None,
        "record_count": record_count,
    }
    return results, summary


def audit_frame(spark: SparkSession, summary: dict, execution_date: str, batch_id: str | None = None,
                decision: str | None = None, validation_time: datetime | None = None) -> DataFrame:
    """Q9: the one-row audit record with an explicit schema."""
    # fixed value: the original audit text format of the validation time
    ts = (validation_time or datetime.now(timezone.utc)).strftime("%Y-%m-%d:%H:%M:%S")
    row = (summary["success"], summary["total_expectations"], summary["passed_expectations"],
           summary["failed_expectations"], summary["pass_rate"], summary["record_count"],
           execution_date, ts, batch_id, decision)
    return literal_rows(spark, [row], AUDIT_SCHEMA)


def write_audit(audit: DataFrame, path: str, batch_id: str | None = None, execution_date: str | None = None) -> None:
    """K3: one folder per record under ``date=<execution_date>/batch=<id>``.

    The record of a batch is replaced when the batch is replayed (no duplicate
    audit rows after a retry); without a batch id a fresh folder is used.
    """
    import uuid

    if execution_date is None:
        execution_date = audit.select("execution_date").first()["execution_date"]
    folder = f"{path.rstrip('/')}/date={execution_date}/batch={batch_id or 'adhoc-' + uuid.uuid4().hex[:12]}"
    audit.coalesce(1).write.mode("overwrite").parquet(folder)


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType(list(AUDIT_SCHEMA.fields) + [T.StructField("date", T.StringType()),
                                                      T.StructField("batch", T.StringType())])
    return spark.read.schema(schema).parquet(path)
