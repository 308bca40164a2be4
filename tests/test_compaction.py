"""Compacted metric histories read as before, also beside a reader and after a crash."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from snapgate.sinks.layers import append_metrics
from snapgate.sources import metrics as mt

SCHEMA = "snapshot_date string, column string, n bigint, run_seq bigint, timestamp string"


def records(spark, path, snapshots=None):
    return sorted((r["snapshot_date"], r["column"], r["n"], r["run_seq"]) for r in mt.read_metrics(spark, path, SCHEMA, snapshots).collect())


def add(spark, path, seq, days="ab"):
    rows = [(d, c, seq * 10) for d in days for c in ("x", "y")]
    append_metrics(spark.createDataFrame(rows, "snapshot_date string, column string, n long").coalesce(1), path, seq, "t")


def files(path, day):
    return [n for n in os.listdir(f"{path}/snapshot_date={day}") if n.endswith(".json") and not n.startswith(("_", "."))]


def test_files_stay_bounded_and_records_whole(spark, tmp_path):
    path, expected = str(tmp_path / "m"), []
    for seq in range(1, 14):
        add(spark, path, seq, "ab" if seq % 2 else "a")
        mt.compact_metrics(spark, path, limit=3)
        expected += [(d, c, seq * 10, seq) for d in ("ab" if seq % 2 else "a") for c in ("x", "y")]
        assert records(spark, path) == sorted(expected)
        assert len(files(path, "a")) <= 8
    assert records(spark, path, ["b"]) == sorted(e for e in expected if e[0] == "b")
    newest = mt.latest_record(mt.read_metrics(spark, path, SCHEMA), ["snapshot_date", "column"], ["run_seq"]).collect()
    assert {(r["snapshot_date"], r["run_seq"]) for r in newest} == {("a", 13), ("b", 13)}
    assert mt.compact_metrics(spark, path, limit=3) == 0 and mt.compact_metrics(spark, str(tmp_path / "none")) == 0


def test_a_reader_under_way_finds_its_files(spark, tmp_path):
    path = str(tmp_path / "m")
    for seq in (1, 2, 3):
        add(spark, path, seq, "a")
    before = mt.read_metrics(spark, path, SCHEMA)
    before.schema   # its files are listed
    assert mt.compact_metrics(spark, path, limit=1) == 1
    assert before.count() == 6 == mt.read_metrics(spark, path, SCHEMA).count()


@pytest.mark.parametrize("step", [1, 2])
def test_a_compaction_that_dies_changes_nothing(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "m")
    for seq in (1, 2, 3):
        add(spark, path, seq, "a")
    whole, put, calls = records(spark, path), mt.put_if_absent, []

    def dying(*args):
        calls.append(args)
        if len(calls) > step:
            raise KeyboardInterrupt
        return put(*args)
    with monkeypatch.context() as m:
        m.setattr(mt, "put_if_absent", dying)
        with pytest.raises(KeyboardInterrupt):
            mt.compact_metrics(spark, path, limit=1)
    assert records(spark, path) == whole
    assert mt.compact_metrics(spark, path, limit=1) == 1 and records(spark, path) == whole
    add(spark, path, 4, "a")
    assert len(records(spark, path)) == 8


def test_two_compactions_at_once(spark, tmp_path):
    path = str(tmp_path / "m")
    for seq in range(1, 6):
        add(spark, path, seq, "a")
    whole = records(spark, path)
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(lambda _: mt.compact_metrics(spark, path, limit=1), range(3)))
    assert records(spark, path) == whole


@pytest.mark.parametrize("first", [1, 2])
def test_of_two_compactions_of_the_same_files_one_counts(spark, tmp_path, monkeypatch, first):
    """Both have claimed before either puts its file, in either order."""
    path = str(tmp_path / "m")
    for seq in (1, 2, 3):
        add(spark, path, seq, "a")
    whole, put, held = records(spark, path), mt.put_if_absent, []
    with monkeypatch.context() as m:
        m.setattr(mt, "put_if_absent", lambda *a: held.append(a) or True if "compact-" in a[1] else put(*a))
        for _ in range(2):
            assert mt.compact_metrics(spark, path, limit=1) == 1
    for args in (held if first == 1 else held[::-1]):
        put(*args)
        assert records(spark, path) == whole
    add(spark, path, 4, "a")
    assert mt.compact_metrics(spark, path, limit=1) == 1 and len(records(spark, path)) == 8
    add(spark, path, 5, "a")
    mt.compact_metrics(spark, path, limit=1)
    assert len(records(spark, path)) == 10 and len(files(path, "a")) <= 4
