from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.increment import high_water_mark, increment, increment_from, increment_subquery

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("processed_date", T.TimestampNTZType())])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_strict_greater_and_null_stamps(spark):
    t1, t2, t3 = datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 1, 3)
    raw = frame(spark, [(1, t1), (2, t2), (3, t2), (4, t3), (5, None)])
    target = frame(spark, [(1, t1), (2, t2)])
    assert high_water_mark(target) is not None
    got = sorted(r.id for r in increment_from(raw, target).collect())
    assert got == [4]  # equal stamp (t2) is not above the mark; NULL never selected


def test_bootstrap_on_empty_target(spark):
    raw = frame(spark, [(1, datetime(1989, 12, 31)), (2, datetime(1990, 1, 1, 0, 0, 1)), (3, None)])
    empty = frame(spark, [])
    assert high_water_mark(empty) is None
    assert sorted(r.id for r in increment_from(raw, empty).collect()) == [2]


def test_subquery_form_matches(spark):
    raw = frame(spark, [(i, datetime(2024, 1, 1 + i)) for i in range(6)])
    target = frame(spark, [(0, datetime(2024, 1, 3))])
    a = sorted(r.id for r in increment_from(raw, target).collect())
    b = sorted(r.id for r in increment_subquery(raw, target).collect())
    assert a == b == [3, 4, 5]


def test_filter_is_pushed_to_parquet(spark, tmp_path):
    raw = frame(spark, [(i, datetime(2024, 1, 1 + i)) for i in range(5)])
    raw.write.parquet(str(tmp_path / "raw"))
    back = spark.read.parquet(str(tmp_path / "raw"))
    inc = increment(back, high_water_mark(frame(spark, [(0, datetime(2024, 1, 2))])))
    plan = inc._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(processed_date" in plan
    assert inc.count() == 3


def test_ltz_column_round_trip(spark):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:00:01")], "id long, s string") \
        .select("id", F.to_timestamp("s").alias("processed_date"))
    mark = high_water_mark(df.filter("id = 1"))
    assert [r.id for r in increment(df, mark).collect()] == [2]


def test_batch_partition_predicate_keeps_rows(spark):
    df = spark.createDataFrame([(1, datetime(2024, 1, 2), "b2"), (2, None, None)],
                               "id long, processed_date timestamp_ntz, batch_id string")
    out = increment(df, None, batch_col="batch_id", min_batch="b1")
    assert [r.id for r in out.collect()] == [1]
