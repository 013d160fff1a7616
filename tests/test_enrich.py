import pytest
from pyspark.sql import types as T

from tidemark.operators.enrich import DuplicateDimensionKey, enrich

DIM = T.StructType([T.StructField("state_abbreviation", T.StringType()),
                    T.StructField("Housing.Housing Units", T.IntegerType()),
                    T.StructField("Income.Per Capita Income", T.DoubleType())])


def dim(spark, rows):
    return spark.createDataFrame(rows, DIM)


def facts(spark):
    return spark.createDataFrame([(1, "CA"), (2, "ca"), (3, None), (4, "ZZ"), (5, "DC"), (6, "CA")],
                                 "invoiceid long, state string")


def test_left_join_keeps_every_fact(spark):
    d = dim(spark, [("CA", 10, 1.5), ("DC", 3, 2.5), ("NY", 7, 3.5)])
    out = enrich(facts(spark), d)
    assert out.columns == ["invoiceid", "state", "State_Housing_Housing_Units", "State_Income_Per_Capita_Income"]
    assert dict(out.schema.fields and [(f.name, f.dataType) for f in out.schema.fields])[
        "State_Housing_Housing_Units"] == T.LongType()  # widened on the way in
    rows = {r.invoiceid: (r.State_Housing_Housing_Units, r.State_Income_Per_Capita_Income) for r in out.collect()}
    assert rows == {1: (10, 1.5), 2: (None, None), 3: (None, None), 4: (None, None), 5: (3, 2.5), 6: (10, 1.5)}


def test_broadcast_when_small(spark):
    out = enrich(facts(spark), dim(spark, [("CA", 10, 1.5)]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftOuter" in plan


def test_no_broadcast_past_the_bound(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = enrich(facts(spark), dim(spark, [("CA", 10, 1.5), ("NY", 1, 1.0)]), max_rows=1)
        plan = out._jdf.queryExecution().executedPlan().toString()
        # only the few dimension rows of hot keys are broadcast; all other rows meet in a shuffle join
        assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") <= 1
        assert out.count() == 6
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_duplicate_dimension_key_is_refused(spark):
    for bound in (1, 100):  # past the broadcast bound and below it
        with pytest.raises(DuplicateDimensionKey):
            enrich(facts(spark), dim(spark, [("CA", 1, 1.0), ("CA", 2, 2.0)]), max_rows=bound)
    # the original would fan out; on request we keep that behaviour
    out = enrich(facts(spark), dim(spark, [("CA", 1, 1.0), ("CA", 2, 2.0)]), on_duplicate="keep")
    assert out.count() == 8


def test_dimension_rewritten_under_the_same_name_is_measured_again(spark, tmp_path):
    folder = str(tmp_path / "dim")
    dim(spark, [("CA", 1, 1.0)]).coalesce(1).write.parquet(folder)
    name = next(p for p in (tmp_path / "dim").iterdir() if p.name.startswith("part-"))
    assert enrich(facts(spark), spark.read.parquet(folder)).count() == 6
    other = str(tmp_path / "other")
    dim(spark, [("CA", 1, 1.0), ("CA", 2, 2.0)]).coalesce(1).write.parquet(other)
    new = next(p for p in (tmp_path / "other").iterdir() if p.name.startswith("part-"))
    name.write_bytes(new.read_bytes())
    (tmp_path / "dim" / f".{name.name}.crc").unlink(missing_ok=True)
    spark.catalog.refreshByPath(folder)
    with pytest.raises(DuplicateDimensionKey):
        enrich(facts(spark), spark.read.parquet(folder))
