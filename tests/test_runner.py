from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

import tidemark.plans.runner as P
from tidemark.operators.ledger import current_state, read_ledger
from tidemark.plans.tables import read_table
from tidemark.schemas import DIMENSION_COLUMNS, US_STATES, dimension_schema
from tidemark.sources.synth import synth_transactions
from tidemark.streaming.ingest import run_stream_to_end

T0 = datetime(2024, 3, 1, tzinfo=timezone.utc)


def clock(i):
    return T0 + timedelta(hours=i)


def dimension(spark):
    rows = []
    for i, s in enumerate(US_STATES[:40] + ["DC"]):
        rows.append(tuple([s] + [i * 10 + j for j in range(len(DIMENSION_COLUMNS) - 2)] + [1000.5 + i, 500.25 + i]))
    return spark.createDataFrame(rows, dimension_schema())


def landing(spark, root, n_files, rows_per_file, key_offset=0, folder="raw"):
    keys = spark.range(key_offset, key_offset + n_files * rows_per_file)
    df = synth_transactions(keys, "id")
    df.repartition(n_files, "invoiceid").write.mode("append").parquet(f"{root}/{folder}")


@pytest.fixture()
def cfg(spark, tmp_path):
    c = P.PipelineConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / "lake"))
    P.bootstrap(spark, c, dimension(spark))
    return c


def enriched(spark, cfg):
    dim = spark.read.parquet(f"{cfg.root}/dimension")
    return read_table(spark, cfg.enriched_table(dim.schema))


def test_empty_landing(spark, cfg):
    assert P.run_batch(spark, cfg, clock(0)).status == "empty"


def test_accepted_batch_and_rerun(spark, cfg):
    landing(spark, cfg.landing, 5, 100)
    r = P.run_batch(spark, cfg, clock(0))
    assert r.status == "loaded" and r.inserted == 500 and len(r.paths) == 5
    e = enriched(spark, cfg)
    assert e.count() == 500 and e.select("invoiceid").distinct().count() == 500
    assert len(e.columns) == 30 and "State_Income_Median_Houseold_Income" in e.columns
    # unknown states (the last 10 of the 50) carry NULL dimension values
    assert e.filter(F.col("State_Housing_Households").isNull()).count() > 0
    assert P.run_batch(spark, cfg, clock(1)).status == "empty"
    states = {r.state for r in current_state(read_ledger(spark, cfg.ledger_path)).collect()}
    assert states == {"archived"}


def test_partial_batch_is_quarantined(spark, cfg):
    landing(spark, cfg.landing, 3, 100)
    r = P.run_batch(spark, cfg, clock(0))
    assert r.status == "quarantined" and r.summary["record_count"] == 300
    q = spark.read.parquet(cfg.quarantine_path)
    assert q.count() == 300
    assert read_table(spark, cfg.raw_table()).count() == 0
    audit = spark.read.parquet(cfg.audit_path)
    assert audit.first().decision == "quarantine"


def test_redelivered_keys_are_not_merged_twice(spark, cfg):
    landing(spark, cfg.landing, 5, 100)
    landing(spark, cfg.landing, 5, 100, folder="zz_again")  # same invoice ids again, other folder
    res = P.run_all(spark, cfg, clock=clock)
    assert [r.status for r in res] == ["loaded", "loaded"]
    assert res[1].inserted == 0
    assert read_table(spark, cfg.raw_table()).count() == 1000
    assert enriched(spark, cfg).count() == 500


def test_stamps_must_increase(spark, cfg):
    landing(spark, cfg.landing, 5, 100)
    landing(spark, cfg.landing, 5, 100, key_offset=1000, folder="zz")
    P.run_batch(spark, cfg, clock(5))
    with pytest.raises(ValueError):
        P.run_batch(spark, cfg, clock(5))  # equal stamp would hide rows from the increment


def test_crash_half_way_then_replay(spark, cfg, monkeypatch):
    landing(spark, cfg.landing, 5, 100)
    real_append = P.append
    calls = {"n": 0}

    def flaky(table, df, batch_id=None, **kw):
        calls["n"] += 1
        if table.path.endswith("/enriched"):
            real_append(table, df.limit(50), batch_id, **kw)  # half of the rows committed ...
            raise RuntimeError("executor lost")  # ... then the job dies
        return real_append(table, df, batch_id, **kw)

    monkeypatch.setattr(P, "append", flaky)
    with pytest.raises(RuntimeError):
        P.run_batch(spark, cfg, clock(0))
    assert enriched(spark, cfg).count() == 50
    monkeypatch.setattr(P, "append", real_append)
    r = P.run_batch(spark, cfg, clock(1))  # resumes the pending batch with its original stamp
    assert r.status == "loaded" and r.batch_time == clock(0)
    e = enriched(spark, cfg)
    assert e.count() == 500 and e.select("invoiceid").distinct().count() == 500
    assert read_table(spark, cfg.raw_table()).count() == 500


def test_stream_equals_batch(spark, cfg, tmp_path):
    landing(spark, cfg.landing, 5, 100)
    landing(spark, cfg.landing, 5, 100, key_offset=1000, folder="zz")
    run_stream_to_end(spark, cfg, clock=clock)
    streamed = sorted(r.invoiceid for r in enriched(spark, cfg).select("invoiceid").collect())
    other = P.PipelineConfig(landing=cfg.landing, root=str(tmp_path / "lake2"))
    P.bootstrap(spark, other, dimension(spark))
    P.run_all(spark, other, clock=clock)
    batch = sorted(r.invoiceid for r in enriched(spark, other).select("invoiceid").collect())
    assert streamed == batch and len(batch) == 1000


def test_archive_and_quarantine_moves(spark, tmp_path):
    import os

    c = P.PipelineConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / "lake"),
                         archive_dir=str(tmp_path / "archive"), quarantine_files_dir=str(tmp_path / "quar"))
    P.bootstrap(spark, c, dimension(spark))
    landing(spark, c.landing, 5, 100)                               # accepted batch
    landing(spark, c.landing, 2, 100, key_offset=5000, folder="z")  # 200 rows: refused
    res = P.run_all(spark, c, clock=clock)
    assert [r.status for r in res] == ["loaded", "quarantined"]

    def files(d):
        return sorted(os.path.relpath(os.path.join(r, f), d) for r, _, fs in os.walk(d) for f in fs
                      if f.endswith(".parquet"))

    assert files(c.landing) == []
    assert len(files(str(tmp_path / "archive"))) == 5 and all(f.startswith("raw/") for f in files(str(tmp_path / "archive")))
    assert len(files(str(tmp_path / "quar"))) == 2 and all(f.startswith("z/") for f in files(str(tmp_path / "quar")))
    assert P.run_batch(spark, c, clock(9)).status == "empty"


def test_edge_rows_flow_through_the_merge(spark, tmp_path):
    """Duplicates, NULL key, known key, odd states, NULL and far-out dates in one accepted batch."""
    import calendar

    from tidemark.operators.quality import RowCountBetween
    from tidemark.schemas import LANDING_SCHEMA

    def ep(y, m=6):
        return calendar.timegm((y, m, 1, 0, 0, 0))

    c = P.PipelineConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / "lake"),
                         suite=(RowCountBetween(1, None),), min_records=1)
    P.bootstrap(spark, c, dimension(spark))
    first = [(1, 1, 1, "c", 10.0, 1, ep(2021), "CA", "Standard", "r")]
    spark.createDataFrame(first, LANDING_SCHEMA).coalesce(1).write.parquet(f"{c.landing}/a")
    P.run_batch(spark, c, clock(0))
    rows = [
        (1, 1, 1, "c", 11.0, 1, ep(2022), "CA", "Standard", "r"),      # already in the target
        (2, 1, 1, "c", 12.0, 1, ep(2019), "ca", "Standard", "r"),      # lower-case state
        (2, 2, 1, "c", 13.0, 1, ep(2026), "ZZ", "Standard", "r"),      # duplicate id, unknown state
        (None, 1, 1, "c", 14.0, 1, ep(2023), None, "Standard", "r"),   # NULL id, NULL state
        (3, 1, 1, "c", 15.0, 1, None, "DC", "Standard", "r"),          # NULL date, DC
        (4, 1, 1, "c", 16.0, 1, 253402300800, "NY", "Standard", "r"),  # year 10000
    ]
    spark.createDataFrame(rows, LANDING_SCHEMA).coalesce(1).write.parquet(f"{c.landing}/b")
    r = P.run_batch(spark, c, clock(1))
    assert r.status == "loaded" and r.inserted == 5
    e = enriched(spark, c)
    # (year 10000 does not fit a Python datetime: collect only what is checked)
    got = sorted(((x.invoiceid or -1), x.price, x.State_Housing_Households)
                 for x in e.select("invoiceid", "price", "State_Housing_Households").collect())
    dc = dimension(spark).filter("state_abbreviation = 'DC'").first()["Housing.Households"]
    ca = dimension(spark).filter("state_abbreviation = 'CA'").first()["Housing.Households"]
    ny = dimension(spark).filter("state_abbreviation = 'NY'").first()["Housing.Households"]
    assert got == [(-1, 14.0, None), (1, 10.0, ca), (2, 12.0, None), (2, 13.0, None), (3, 15.0, dc), (4, 16.0, ny)]
    raw = read_table(spark, c.raw_table(), keep_hidden=True)
    months = {x.invoiceid: x.order_month
              for x in raw.filter("invoiceid in (3, 4)").select("invoiceid", "order_month").collect()}
    assert months[3] is None and months[4] == (10000 - 1970) * 12  # January of year 10000


def test_command_line(spark, tmp_path):
    from tidemark.cli import main
    from tidemark.schemas import DIMENSION_KEY

    csv = str(tmp_path / "county.csv")
    county = dimension(spark).withColumnRenamed(DIMENSION_KEY, "State")
    county.write.option("header", True).csv(csv)
    root, land = str(tmp_path / "lake"), str(tmp_path / "landing")
    out = main(["bootstrap", "--landing", land, "--root", root, "--dimension-csv", csv, "--rollup-key", "State"],
               spark=spark)
    assert out["enriched"].endswith("/enriched")
    landing(spark, land, 5, 100)
    got = main(["run-all", "--landing", land, "--root", root, "--archive-dir", str(tmp_path / "arch")], spark=spark)
    assert [b["status"] for b in got["batches"]] == ["loaded"] and got["batches"][0]["inserted"] == 500
    assert main(["run-batch", "--landing", land, "--root", root], spark=spark)["status"] == "empty"
    assert "snapshot" in main(["compact-ledger", "--root", root], spark=spark)
    assert main(["tidy-landing", "--landing", land, "--root", root, "--archive-dir", str(tmp_path / "arch")],
                spark=spark) == {"moved": 0}


def test_stream_failure_then_restart(spark, cfg, tmp_path, monkeypatch):
    import tidemark.streaming.ingest as S

    landing(spark, cfg.landing, 5, 100)
    landing(spark, cfg.landing, 5, 100, key_offset=1000, folder="zz")
    real = S.process_batch
    calls = {"n": 0}

    def failing(*a, **k):
        calls["n"] += 1
        if calls["n"] == 2:
            raise RuntimeError("executor lost during micro-batch")
        return real(*a, **k)

    monkeypatch.setattr(S, "process_batch", failing)
    with pytest.raises(Exception):
        run_stream_to_end(spark, cfg, clock=clock)
    pending = [r for r in current_state(read_ledger(spark, cfg.ledger_path)).collect() if r.state == "pending"]
    assert len(pending) == 5
    monkeypatch.setattr(S, "process_batch", real)
    run_stream_to_end(spark, cfg, clock=lambda i: clock(100 + i))  # restart: the failed micro-batch replays
    e = enriched(spark, cfg)
    assert e.count() == 1000 and e.select("invoiceid").distinct().count() == 1000
    states = {r.state for r in current_state(read_ledger(spark, cfg.ledger_path)).collect()}
    assert states == {"archived"}
    # the replay kept the stamp recorded before the failure
    stamps = {r.batch_id for r in read_ledger(spark, cfg.ledger_path).collect()}
    assert len(stamps) == 2


def test_unreadable_file_is_quarantined_not_retried_forever(spark, cfg):
    import os

    landing(spark, cfg.landing, 5, 100)
    os.makedirs(f"{cfg.landing}/a_bad", exist_ok=True)
    with open(f"{cfg.landing}/a_bad/broken.parquet", "wb") as fh:
        fh.write(b"this is not parquet")
    cfg2 = P.PipelineConfig(landing=cfg.landing, root=cfg.root, max_files=1)
    first = P.run_batch(spark, cfg2, clock(0))
    assert first.status == "quarantined" and first.paths[0].endswith("broken.parquet")
    assert first.summary["record_count"] is None
    audit = spark.read.parquet(cfg2.audit_path).first()
    assert audit.decision == "quarantine" and audit.pass_rate == 0.0
    nxt = P.run_batch(spark, cfg2, clock(1))  # the pipeline moves on
    assert nxt.paths and not nxt.paths[0].endswith("broken.parquet")


def test_file_delivered_again_under_the_same_name(spark, cfg, tmp_path):
    import os
    import time

    from tidemark.operators.quality import RowCountBetween

    c = P.PipelineConfig(landing=cfg.landing, root=cfg.root, max_files=5, suite=(RowCountBetween(1, None),),
                         min_records=1)
    os.makedirs(c.landing, exist_ok=True)
    target = f"{c.landing}/transaction11.parquet"

    def deliver(offset):
        pdf = synth_transactions(spark.range(offset, offset + 100), "id").toPandas()
        pdf.to_parquet(target + ".tmp", index=False)
        os.replace(target + ".tmp", target)

    deliver(0)
    assert P.run_batch(spark, c, clock(0)).inserted == 100
    assert P.run_batch(spark, c, clock(1)).status == "empty"  # same file, same version: seen
    time.sleep(0.01)
    deliver(5000)  # a new delivery with the same name (new modification time)
    os.utime(target, (time.time() + 5, time.time() + 5))
    r = P.run_batch(spark, c, clock(2))
    assert r.status == "loaded" and r.inserted == 100
    assert enriched(spark, c).count() == 200


def test_tidy_landing_finishes_interrupted_moves(spark, tmp_path, monkeypatch):
    import os

    c = P.PipelineConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / "lake"),
                         archive_dir=str(tmp_path / "archive"))
    P.bootstrap(spark, c, dimension(spark))
    landing(spark, c.landing, 5, 100)
    monkeypatch.setattr(P, "move_files", lambda *a, **k: [])  # crash right after the ledger write
    assert P.run_batch(spark, c, clock(0)).status == "loaded"
    monkeypatch.undo()
    left = [f for r, _, fs in os.walk(c.landing) for f in fs if f.endswith(".parquet")]
    assert len(left) == 5
    assert P.run_batch(spark, c, clock(1)).status == "empty"  # finished files are never picked again
    assert P.tidy_landing(spark, c) == 5
    assert [f for r, _, fs in os.walk(c.landing) for f in fs if f.endswith(".parquet")] == []


def test_stream_with_moves(spark, tmp_path):
    import os

    c = P.PipelineConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / "lake"),
                         archive_dir=str(tmp_path / "archive"))
    P.bootstrap(spark, c, dimension(spark))
    landing(spark, c.landing, 5, 100)
    landing(spark, c.landing, 5, 100, key_offset=1000, folder="zz")
    run_stream_to_end(spark, c, clock=clock)
    assert enriched(spark, c).count() == 1000
    assert [f for r, _, fs in os.walk(c.landing) for f in fs if f.endswith(".parquet")] == []
    run_stream_to_end(spark, c, clock=lambda i: clock(50 + i))  # restart: nothing new, nothing missing
    assert enriched(spark, c).count() == 1000


def test_target_probe_reads_only_overlapping_batch_folders(spark, tmp_path):
    from tidemark.operators.quality import RowCountBetween

    c = P.PipelineConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / "lake"), max_files=1,
                         suite=(RowCountBetween(1, None),), min_records=1)
    P.bootstrap(spark, c, dimension(spark))
    def growing(off, folder):  # invoice ids off .. off+99: ids grow from batch to batch
        df = synth_transactions(spark.range(off, off + 100), "id").coalesce(1)
        df = df.withColumn("invoiceid", F.monotonically_increasing_id() + F.lit(off))  # one partition: 0..99
        df.write.mode("append").parquet(f"{c.landing}/{folder}")

    for i, off in enumerate([0, 1000, 2000]):  # three batches with growing, disjoint invoice ids
        growing(off, f"f{i}")
        assert P.run_batch(spark, c, clock(i)).inserted == 100
    dim = spark.read.parquet(f"{c.root}/dimension")
    enr_t = c.enriched_table(dim.schema)
    ledger = read_ledger(spark, c.ledger_path)
    batches = sorted({r.batch_id for r in ledger.collect()})
    kr = {r.batch_id: (r.key_min, r.key_max) for r in ledger.filter("state = 'archived'").collect()}
    assert all(lo is not None and lo <= hi for lo, hi in kr.values())
    # a key range inside the second batch's range: only that folder is probed
    lo, hi = kr[batches[1]]
    probe = P.probe_target(spark, enr_t, ledger, "current", lo, hi)
    assert all(f"batch_id={batches[1]}" in f for f in probe.inputFiles())
    assert probe.count() == 100
    # a re-delivery of the first batch's ids is still recognised with pruning on
    growing(0, "g_again")
    r = P.run_batch(spark, c, clock(9))
    assert r.status == "loaded" and r.inserted == 0
    assert enriched(spark, c).count() == 300


def test_target_probe_keeps_untracked_folders(spark, tmp_path):
    from tidemark.plans.tables import append as table_append

    c = P.PipelineConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / "lake"))
    P.bootstrap(spark, c, dimension(spark))
    landing(spark, c.landing, 5, 100)
    P.run_batch(spark, c, clock(0))
    dim = spark.read.parquet(f"{c.root}/dimension")
    enr_t = c.enriched_table(dim.schema)
    rows = P.read_table(spark, enr_t).limit(3)
    table_append(enr_t, rows, batch_id="loaded-elsewhere")  # content the ledger never saw
    ledger = read_ledger(spark, c.ledger_path)
    probe = P.probe_target(spark, enr_t, ledger, "current", 10**12, 10**12 + 1)
    assert probe.count() == 3  # the tracked batch is skipped (range misses), the untracked one kept
    # unknown layout (a data file at the table root): no pruning
    spark.range(1).write.mode("append").parquet(f"{enr_t.path}/../stray")
    import shutil, glob
    f = glob.glob(f"{c.root}/stray/*.parquet")[0]
    shutil.copy(f, f"{enr_t.path}/stray.parquet")
    assert P.probe_target(spark, enr_t, ledger, "current", 0, 1) is None


def test_command_line_stream(spark, tmp_path):
    from tidemark.cli import main
    from tidemark.schemas import DIMENSION_KEY

    csv = str(tmp_path / "dim.csv")
    dimension(spark).write.option("header", True).csv(csv)
    root, land = str(tmp_path / "lake"), str(tmp_path / "landing")
    main(["bootstrap", "--landing", land, "--root", root, "--dimension-csv", csv], spark=spark)
    landing(spark, land, 5, 100)
    assert main(["stream", "--landing", land, "--root", root], spark=spark) == {"stream": "done"}
    dim = spark.read.parquet(f"{root}/dimension")
    assert DIMENSION_KEY in dim.columns
    e = P.read_table(spark, P.PipelineConfig(landing=land, root=root).enriched_table(dim.schema))
    assert e.count() == 500


def test_stream_quarantines_broken_and_empty_files(spark, cfg):
    import os

    landing(spark, cfg.landing, 2, 500)
    os.makedirs(f"{cfg.landing}/bad", exist_ok=True)
    with open(f"{cfg.landing}/bad/broken.parquet", "wb") as fh:
        fh.write(b"this is not parquet")
    synth_transactions(spark.range(0), "id").coalesce(1).write.parquet(f"{cfg.landing}/empty")
    c = P.PipelineConfig(landing=cfg.landing, root=cfg.root, max_files=1)
    run_stream_to_end(spark, c, clock=clock)
    states = {r.path.rsplit("/", 2)[1]: r.state for r in current_state(read_ledger(spark, c.ledger_path)).collect()}
    assert states == {"raw": "quarantined" if enriched(spark, c).count() == 0 else "archived",
                      "bad": "quarantined", "empty": "quarantined"}
    listed = [f for _, _, fs in os.walk(c.landing) for f in fs if f.endswith(".parquet")]
    assert current_state(read_ledger(spark, c.ledger_path)).count() == len(listed)


def test_passing_read_error_keeps_the_batch_pending(spark, cfg, monkeypatch):
    landing(spark, cfg.landing, 5, 100)
    real = P.run_suite
    monkeypatch.setattr(P, "run_suite", lambda *a: (_ for _ in ()).throw(OSError("store does not answer")))
    with pytest.raises(OSError, match="does not answer"):
        P.run_batch(spark, cfg, clock(0))
    monkeypatch.setattr(P, "run_suite", real)
    assert P.run_batch(spark, cfg, clock(1)).inserted == 500


def test_moves_never_replace_a_file(spark, tmp_path):
    from tidemark.sources.fs import move_files

    land, dest = tmp_path / "land", tmp_path / "dest"
    for text in ("one", "two"):
        land.mkdir(exist_ok=True)
        (land / "a.parquet").write_text(text)
        assert len(move_files(spark, [str(land / "a.parquet")], str(land), str(dest))) == 1
    assert sorted(p.read_text() for p in dest.iterdir() if not p.name.startswith(".")) == ["one", "two"]
    assert move_files(spark, [str(land / "a.parquet")], str(land), str(dest)) == []


def test_increment_reads_unstamped_batch_keys(spark):
    from tidemark.operators.increment import increment

    rows = [(1, "20240101T000000000000Z"), (2, "20230101T000000000000Z"), (3, None), (4, "backfill-7"), (5, "0")]
    raw = spark.createDataFrame(rows, "id long, batch_id string").withColumn("processed_date", F.lit(T0))
    got = increment(raw, None, "processed_date", batch_col="batch_id", min_batch="20230601T000000000000Z")
    assert {r["id"] for r in got.collect()} == {1, 3, 4, 5}


def test_scratch_needs_a_shared_folder_off_local_mode(monkeypatch):
    from types import SimpleNamespace

    from tidemark.session import checkpoint_root

    conf = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(SimpleNamespace(sparkContext=sc, conf=conf))
