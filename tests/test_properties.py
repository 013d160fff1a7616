"""Pipeline properties (survey §5 item 3) on seeded synthetic landing files."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import tidemark.plans.runner as P
from tidemark.operators.ledger import current_state, read_ledger
from tidemark.operators.quality import Between, MatchRegex, NotNull
from tidemark.plans.tables import read_table
from tidemark.schemas import DATE_REGEX
from tidemark.session import DEFAULT_PROFILE, profile
from tidemark.sources.synth import synth_transactions

from tests.test_runner import dimension

SUITE = (NotNull("invoiceid"), MatchRegex("orderdate_date", DATE_REGEX), Between("orderdate_year", 2020, 2025))


def clock(i):
    return datetime(2024, 6, 1, tzinfo=timezone.utc) + timedelta(minutes=i)


def write_landing(spark, folder, seed):
    """6 files of 40 rows with unique ids, plus one file with a NULL id (refused by the suite)."""
    keys = spark.range(0, 240)
    synth_transactions(keys, "id", seed=seed).repartition(6, "invoiceid").write.parquet(f"{folder}/a")
    bad = synth_transactions(spark.range(10_000, 10_010), "id", seed=seed).withColumn(
        "invoiceid", F.when(F.col("quantity") > 0, None).cast("long"))
    bad.coalesce(1).write.parquet(f"{folder}/b")


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("landing"))
    write_landing(spark, folder, seed=7)
    return folder


@pytest.mark.parametrize("max_files", [1, 2, 5])
def test_batch_size_does_not_change_the_result(spark, tmp_path, landing, max_files):
    cfg = P.PipelineConfig(landing=landing, root=str(tmp_path / "lake"), max_files=max_files, suite=SUITE,
                           min_records=1)
    P.bootstrap(spark, cfg, dimension(spark))
    res = P.run_all(spark, cfg, clock=clock)
    dim = spark.read.parquet(f"{cfg.root}/dimension")
    keys = {r.invoiceid for r in read_table(spark, cfg.enriched_table(dim.schema)).select("invoiceid").collect()}
    # (b) with unique ids, the enriched key set is the set of ids in accepted batches
    accepted_paths = [p for r in res if r.status == "loaded" for p in r.paths]
    accepted = read_table(spark, cfg.raw_table())
    assert keys == {r.invoiceid for r in accepted.select("invoiceid").collect()}
    # the NULL-id file is refused together with whatever shares its batch
    refused = [p for r in res if r.status == "quarantined" for p in r.paths]
    assert any("/b/" in p for p in refused)
    if max_files == 1:
        assert len(keys) == 240
    # (c) every landing file ends in exactly one terminal state
    states = current_state(read_ledger(spark, cfg.ledger_path)).collect()
    assert sorted(s.path for s in states) == sorted(accepted_paths + refused)
    assert {s.state for s in states} <= {"archived", "quarantined"}
    # (d) raw row count = sum of accepted batch counts
    assert accepted.count() == sum(r.summary["record_count"] for r in res if r.status == "loaded")


def test_profile_sets_runtime_conf(spark):
    old = {k: spark.conf.get(k, None) for k in DEFAULT_PROFILE}
    try:
        got = profile(spark, spark_sql_shuffle_partitions="6")
        assert got["spark.sql.shuffle.partitions"] == "6"
        assert spark.conf.get("spark.sql.shuffle.partitions") == "6"
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == str(50 * 1024 * 1024)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
