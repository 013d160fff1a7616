"""The folder cursor finds what a whole listing finds, with few listing calls."""

import os
import random

import pytest

import tidemark.plans.runner as P
from tidemark.operators.ledger import next_batch, read_ledger, record
from tidemark.operators.quality import RowCountBetween
from tidemark.sources import cursor as C
from tidemark.sources.files import list_files

from .test_runner import clock, dimension, landing


def touch(folder, *names, at=1_700_000_000):
    folder.mkdir(parents=True, exist_ok=True)
    for n in names:
        (folder / n).write_bytes(b"x")
        os.utime(folder / n, (at, at))
    os.utime(folder, (at, at))


def take(spark, root, ledger_path, finished, n):
    """One batch: list, record, remember."""
    found = C.next_files(spark, str(root), read_ledger(spark, ledger_path), finished, n)
    finished.update(found.finished)
    if found.files:
        record(spark, ledger_path, found.files, f"b{random.random()}", clock(0), "archived")
    return found


def test_a_thousand_folders_cost_a_few_calls(spark, tmp_path):
    root, ledger = tmp_path / "in", str(tmp_path / "ledger")
    for i in range(1000):
        touch(root / f"day={i:04d}", "a.parquet")
    first = C.next_files(spark, str(root), read_ledger(spark, ledger), {}, 5)
    assert first.listed == 6 and [p.split("/")[-2] for p, _ in first.files] == [f"day={i:04d}" for i in range(5)]
    # all but the last folders are finished: only those are looked into
    done = {f"file:{root}/day={i:04d}": 1_700_000_000_000 for i in range(995)}
    last = C.next_files(spark, str(root), read_ledger(spark, ledger), done, 50)
    assert last.listed == 6 and len(last.files) == 5
    # the same files as a whole listing
    want = [(r["path"], r["version"]) for r in next_batch(list_files(spark, str(root)), read_ledger(spark, ledger), 5).collect()]
    assert first.files == want


def test_late_and_rewritten_files_are_found(spark, tmp_path):
    root, ledger, finished = tmp_path / "in", str(tmp_path / "ledger"), {}
    for d in ("d1", "d2", "d3"):
        touch(root / d, "a.parquet", "b.parquet")
    assert len(take(spark, root, ledger, finished, 4).files) == 4
    assert [p[-12:] for p, _ in take(spark, root, ledger, finished, 4).files] == ["d3/a.parquet", "d3/b.parquet"]
    none = take(spark, root, ledger, finished, 4)
    assert none.files == [] and none.listed <= 2 and len(finished) == 3
    assert take(spark, root, ledger, finished, 4).listed == 1
    touch(root / "d1", "late.parquet", at=1_700_000_100)
    late = take(spark, root, ledger, finished, 4)
    assert [p[-15:] for p, _ in late.files] == ["d1/late.parquet"] and late.listed == 2
    touch(root / "d2", "a.parquet", at=1_700_000_200)  # written again under its name
    assert [p[-12:] for p, _ in take(spark, root, ledger, finished, 4).files] == ["d2/a.parquet"]


def test_a_folder_that_changed_just_now_is_looked_at_again(spark, tmp_path):
    root, ledger = tmp_path / "in", str(tmp_path / "ledger")
    touch(root / "d1", "a.parquet")
    take(spark, root, ledger, {}, 5)
    t = 1_700_000_000_000
    known = read_ledger(spark, ledger)
    assert C.next_files(spark, str(root), known, {}, 5, now_ms=t + 500).finished == {}
    assert C.next_files(spark, str(root), known, {}, 5, now_ms=t + 60_000).finished == {f"file:{root}/d1": t}


def test_loose_files_nested_and_hidden_folders(spark, tmp_path):
    root, ledger, finished = tmp_path / "in", str(tmp_path / "ledger"), {}
    touch(root / "b" / "deep", "n.parquet")
    touch(root / "a", "x.parquet", "skip.csv", "_tmp.parquet")
    touch(root / "_staging", "h.parquet")
    touch(root, "c.parquet", "a.parquet")
    order = []
    while found := take(spark, root, ledger, finished, 1).files:
        order += [p.removeprefix(f"file:{root}/") for p, _ in found]
    assert order == ["a.parquet", "a/x.parquet", "b/deep/n.parquet", "c.parquet"]
    touch(root / "b" / "deep", "m.parquet", at=1_700_000_300)  # does not change b's own time
    assert len(take(spark, root, ledger, finished, 9).files) == 1
    assert C.next_files(spark, str(tmp_path / "missing"), read_ledger(spark, ledger), {}, 3).files == []


def test_stores_without_folder_times(spark, tmp_path, monkeypatch):
    root, ledger, finished = tmp_path / "in", str(tmp_path / "ledger"), {}
    touch(root / "d1", "a.parquet")
    from dataclasses import replace

    real = C.child_files
    monkeypatch.setattr(C, "child_files", lambda s, f: [replace(x, modified=0) if x.is_folder else x for x in real(s, f)])
    assert len(take(spark, root, ledger, finished, 5).files) == 1
    assert take(spark, root, ledger, finished, 5).files == [] and finished == {}
    touch(root / "d1", "b.parquet")
    assert len(take(spark, root, ledger, finished, 5).files) == 1


@pytest.mark.parametrize("forget", [False, True])
def test_the_pipeline_with_a_cursor(spark, tmp_path, forget):
    c = P.PipelineConfig(landing=str(tmp_path / "landing"), root=str(tmp_path / "lake"), max_files=2,
                         suite=(RowCountBetween(1, None),), min_records=1, folder_cursor=True)
    P.bootstrap(spark, c, dimension(spark))
    landing(spark, c.landing, 2, 20, folder="d1")
    assert P.run_batch(spark, c, clock(0)).inserted == 40
    landing(spark, c.landing, 1, 10, key_offset=1000, folder="d2")
    assert P.run_batch(spark, c, clock(1)).inserted == 10
    if forget:
        C.reset_cursor(spark, c.cursor_path)
    landing(spark, c.landing, 1, 10, key_offset=2000, folder="d1")  # late, in an old folder
    assert P.run_batch(spark, c, clock(2)).inserted == 10
    assert P.run_batch(spark, c, clock(3)).status == "empty"
