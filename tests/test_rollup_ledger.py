from datetime import datetime

from pyspark.sql import types as T

from tidemark.functions.columns import normalise_names
from tidemark.operators.ledger import current_state, ledger_rows, next_batch, pending_batch
from tidemark.operators.rollup import rollup_dimension
from tidemark.schemas import LEDGER_SCHEMA


def test_rollup_sums_and_means(spark):
    schema = T.StructType([T.StructField("State", T.StringType()), T.StructField("Pop.Total", T.IntegerType()),
                           T.StructField("Income.Median", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("ratio", T.DoubleType())])
    df = spark.createDataFrame([("CA", 10, 100, "a", 0.5), ("CA", 5, 50, "b", 0.1), ("NY", 1, 7, "c", 0.2),
                                (None, 99, 99, "d", 0.3)], schema)
    out = rollup_dimension(df)
    assert out.columns == ["state_abbreviation", "Pop.Total", "Income.Median"]
    assert dict((f.name, f.dataType) for f in out.schema.fields)["Pop.Total"] == T.LongType()
    rows = {r[0]: (r[1], r[2]) for r in out.collect()}
    assert rows == {"CA": (15, 75.0), "NY": (1, 7.0)}
    assert normalise_names(out).columns == ["state_abbreviation", "Pop_Total", "Income_Median"]


def test_next_batch_lexicographic_and_unseen(spark):
    listing = spark.createDataFrame([(p,) for p in ["s3a://b/raw/t2.parquet", "s3a://b/raw/t10.parquet",
                                                     "s3a://b/raw/t1.parquet", "s3a://b/other/t1.parquet"]], "path string")
    ledger = ledger_rows(spark, ["s3a://b/raw/t1.parquet"], "b0", datetime(2024, 1, 1), "archived")
    got = [r.path for r in next_batch(listing, ledger, 2).collect()]
    # same basename in another folder is a different file; t10 sorts before t2
    assert got == ["s3a://b/other/t1.parquet", "s3a://b/raw/t10.parquet"]


def test_current_state_uses_seq_for_equal_times(spark):
    t = datetime(2024, 1, 1)
    rows = [("f", "b1", t, "pending", t, 1, None, 7, None, None, None), ("f", "b1", t, "loaded", t, 2, 10, 7, 1, 5, None),
            ("f", "b1", t, "archived", t, 3, 10, 7, 1, 5, None), ("g", "b2", t, "pending", t, 4, None, 7, None, None, None)]
    ledger = spark.createDataFrame(rows, LEDGER_SCHEMA)
    state = {r.path: r.state for r in current_state(ledger).collect()}
    assert state == {"f": "archived", "g": "pending"}
    pend = pending_batch(ledger)
    assert pend.batch_id == "b2" and pend.paths == ["g"]


def test_empty_listing(spark):
    listing = spark.createDataFrame([], "path string")
    ledger = spark.createDataFrame([], LEDGER_SCHEMA)
    assert next_batch(listing, ledger, 5).count() == 0


def test_compaction_keeps_current_state(spark, tmp_path):
    from datetime import timezone

    from tidemark.operators.ledger import compact_ledger, read_ledger, record, summarise_ledger

    path = str(tmp_path / "ledger")
    t = datetime(2024, 1, 1)
    d1, d2 = datetime(2024, 1, 1, 5, tzinfo=timezone.utc), datetime(2024, 1, 2, 5, tzinfo=timezone.utc)
    record(spark, path, ["a", "b"], "b1", t, "pending", at=d1)
    record(spark, path, ["a", "b"], "b1", t, ("loaded", "archived"), watermark_us=5, at=d1)
    record(spark, path, ["c"], "b2", datetime(2024, 1, 2), "pending", at=d2)
    before = sorted(tuple(r) for r in current_state(read_ledger(spark, path)).collect())
    s0 = summarise_ledger(read_ledger(spark, path))
    assert compact_ledger(spark, path, upto="2024-01-02", purge=True) == "2024-01-02"
    after = read_ledger(spark, path)
    assert after.count() == 3  # a, b folded to one row each; c still in the log
    assert sorted(tuple(r) for r in current_state(after).collect()) == before
    s1 = summarise_ledger(after)
    assert (s1.last_batch_id, s1.last_state, s1.watermark_us, s1.pending) == \
        (s0.last_batch_id, s0.last_state, s0.watermark_us, True)
    assert compact_ledger(spark, path, upto="2099-01-01") <= f"{datetime.now(timezone.utc):%Y-%m-%d}"
    record(spark, path, ["c"], "b2", datetime(2024, 1, 2), "quarantined")
    assert {r.path: r.state for r in current_state(read_ledger(spark, path)).collect()}["c"] == "quarantined"


def test_same_name_new_version_is_a_new_file(spark):
    t = datetime(2024, 1, 1)
    listing = spark.createDataFrame([("s3a://b/raw/t1.parquet", 200), ("s3a://b/raw/t2.parquet", 100)],
                                    "path string, version long")
    ledger = ledger_rows(spark, [("s3a://b/raw/t1.parquet", 100), ("s3a://b/raw/t2.parquet", 100)], "b0", t,
                         "archived")
    assert [r.path for r in next_batch(listing, ledger, 5).collect()] == ["s3a://b/raw/t1.parquet"]


def test_batches_to_probe_edges(spark):
    from tidemark.operators.ledger import batches_to_probe

    t = datetime(2024, 1, 1)
    ledger = ledger_rows(spark, ["a"], "b1", t, "archived", key_range=(10, 20)).unionByName(
        ledger_rows(spark, ["b"], "b2", t, "archived", key_range=(1, 0)))  # b2: no key inserted
    assert batches_to_probe(spark, ledger, [], 0, 100) == {}
    assert batches_to_probe(spark, ledger, ["b1", "b2", "b9"], 15, 15) == {"b1": None, "b9": None}  # b9 untracked
    assert batches_to_probe(spark, ledger, ["b1", "b2"], 21, 30) == {}
    assert batches_to_probe(spark, ledger, ["b1", "b2"], None, None) == {"b1": None, "b2": None}  # no range known
    indexed = ledger.unionByName(ledger_rows(spark, ["c"], "b3", t, "archived", key_range=(1, 99), key_blocks=4))
    assert batches_to_probe(spark, indexed, ["b1", "b3"], 0, 100) == {"b1": None, "b3": 4}
