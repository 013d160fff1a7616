from pyspark.sql import functions as F

from tidemark.functions.columns import derive_check_columns
from tidemark.operators.quality import (Between, MatchRegex, NotNull, RowCountBetween, audit_frame, default_suite,
                                        gate, read_audit, run_suite, summarise, validate, write_audit)
from tidemark.schemas import LANDING_SCHEMA
from tidemark.sources.synth import synth_range


def epoch(y, m=1, d=1):
    import calendar
    return calendar.timegm((y, m, d, 0, 0, 0))


def batch(spark, rows):
    full = [(i, 1, 1, "c", 10.0, 1, od, "CA", "Standard", "r") for i, od in rows]
    return spark.createDataFrame(full, LANDING_SCHEMA)


def results(spark, rows, suite=None):
    df = derive_check_columns(batch(spark, rows))
    return {r.expectation: r for r in validate(df, suite or default_suite()).collect()}


def test_clean_batch_of_500_passes(spark):
    df = derive_check_columns(synth_range(spark, 500))
    res, summary = run_suite(df, default_suite())
    assert summary == {"success": True, "total_expectations": 4, "passed_expectations": 4,
                       "failed_expectations": 0, "pass_rate": 100.0, "record_count": 500}
    assert gate(summary) == "load"


def test_row_count_is_exact_499_501(spark):
    for n, ok in [(499, False), (500, True), (501, False)]:
        _, s = run_suite(derive_check_columns(synth_range(spark, n)), default_suite())
        assert s["passed_expectations"] == (4 if ok else 3)
        assert gate(s) == ("load" if ok else "quarantine")


def test_edge_rows(spark):
    r = results(spark, [(None, epoch(2021)), (2, epoch(2019, 6)), (3, epoch(2026, 6)), (4, None),
                        (5, 253402300800)])  # 253402300800 = year 10000
    assert r["expect_column_values_to_not_be_null"].unexpected_count == 1
    # regex only fails for the 5-digit year; NULL dates are ignored
    assert r["expect_column_values_to_match_regex"].unexpected_count == 1
    # 2019, 2026 and 10000 are out of range; NULL ignored
    assert r["expect_column_values_to_be_between"].unexpected_count == 3
    assert not r["expect_table_row_count_to_be_between"].success


def test_empty_batch_counts_zero(spark):
    r = results(spark, [])
    assert r["expect_column_values_to_not_be_null"].unexpected_count == 0
    assert r["expect_table_row_count_to_be_between"].record_count == 0


def test_single_scan(spark, tmp_path):
    synth_range(spark, 50).write.parquet(str(tmp_path / "b"))
    df = derive_check_columns(spark.read.parquet(str(tmp_path / "b")))
    plan = validate(df, default_suite())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 or plan.count("Scan parquet") == 1


def test_summary_frame_and_gate_thresholds(spark):
    df = derive_check_columns(batch(spark, [(1, epoch(2021)), (None, epoch(2022))]))
    suite = [RowCountBetween(1, 10), NotNull("invoiceid"), MatchRegex("orderdate_date", r"^\d{4}-\d{2}-\d{2}$"),
             Between("orderdate_year", 2020, 2025)]
    s = summarise(validate(df, suite)).first().asDict()
    assert s["total_expectations"] == 4 and s["passed_expectations"] == 3 and s["pass_rate"] == 75.0
    assert gate(s, min_pass_rate=75, min_records=2) == "load"
    assert gate(s, min_pass_rate=75, min_records=3) == "quarantine"
    assert gate({"pass_rate": None, "record_count": 5}) == "quarantine"


def test_audit_round_trip(spark, tmp_path):
    _, s = run_suite(derive_check_columns(synth_range(spark, 500)), default_suite())
    path = str(tmp_path / "audit")
    write_audit(audit_frame(spark, s, "2024-05-01", "b1", "load"), path)
    write_audit(audit_frame(spark, s, "2024-05-01", "b2", "load"), path)
    back = read_audit(spark, path)
    assert back.count() == 2
    assert back.filter(F.col("date") == "2024-05-01").select("pass_rate").distinct().first()[0] == 100.0


def test_audit_replay_replaces_the_batch_row(spark, tmp_path):
    _, s = run_suite(derive_check_columns(synth_range(spark, 10)), default_suite())
    path = str(tmp_path / "audit")
    write_audit(audit_frame(spark, s, "2024-05-02", "b7", "quarantine"), path, "b7")
    write_audit(audit_frame(spark, s, "2024-05-02", "b7", "quarantine"), path, "b7")  # replay
    write_audit(audit_frame(spark, s, "2024-05-02", "b8", "quarantine"), path, "b8")
    back = read_audit(spark, path)
    assert sorted(r.batch for r in back.collect()) == ["b7", "b8"]
