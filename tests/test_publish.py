"""Gold and ledger change as one; a version and a run number have one owner."""

import glob
import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from snapgate.config import PLAYER_STATS, Contract, ContractColumn
from snapgate.operators import contracts, gold
from snapgate.plans import jobs
from snapgate.plans.jobs import Run
from snapgate.sinks import layers, publish as pub
from snapgate.sources.raw import ORDER_COLUMNS

DAYS = ["2024-01-01", "2024-01-02"]
COLUMNS = "day string, k int, v string"


def table(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def read(spark, path):
    return sorted(map(tuple, pub.read_published(spark, path, table(spark, []).schema).select("day", "k", "v").collect()), key=repr)


def plain(spark, path):
    return sorted(map(tuple, spark.read.schema(COLUMNS).parquet(path).select("day", "k", "v").collect()), key=repr)


OLD = [("a", 1, "x"), ("b", 2, "x"), (None, 3, "x")]
NEW = [("b", 2, "y"), ("b", 4, "y"), ("c d/é*", 5, "y")]
AFTER = sorted([OLD[0], OLD[2], *NEW], key=repr)


@pytest.mark.parametrize("step", ["stage", "move", "claim", "after", "settle"])
def test_a_load_that_ends_at_any_step_leaves_the_old_or_the_new_state(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "gold")
    first = pub.publish(table(spark, OLD), path, "day", pub.head(spark, path), {"s1": "t1"})
    pub.settle(spark, path, first)

    def die(*args, **kwargs):
        raise KeyboardInterrupt
    put, listed = pub.put_if_absent, pub.listed

    def put_then_die(*args):
        assert put(*args)
        die()
    with monkeypatch.context() as m:
        if step == "stage":
            m.setattr(pub, "listed", lambda spark, at: die() if "_staged" in at else listed(spark, at))
        elif step == "move":     # one partition is moved, the next is not
            seen = []
            m.setattr(pub, "listed", lambda spark, at: die() if "_staged" in at and len(seen) == 2 else (
                seen.append(at) if "_staged" in at else None, listed(spark, at))[1])
        elif step == "claim":
            m.setattr(pub, "put_if_absent", die)
        elif step == "after":
            m.setattr(pub, "put_if_absent", put_then_die)
        else:
            m.setattr(pub, "_delete", die)
        with pytest.raises(KeyboardInterrupt):
            state = pub.publish(table(spark, NEW), path, "day", pub.head(spark, path), {"s2": "t2"})
            pub.settle(spark, path, state)
    done = step in ("after", "settle")
    assert read(spark, path) == (AFTER if done else sorted(OLD, key=repr))
    assert set(pub.head(spark, path).snapshots) == ({"s1", "s2"} if done else {"s1"})
    # the repetition gives the new state, and the folder reads right without the published file too
    state = pub.publish(table(spark, NEW), path, "day", pub.head(spark, path), {"s2": "t2"})
    pub.settle(spark, path, state)
    assert read(spark, path) == AFTER
    pub.tidy(spark, path)
    assert plain(spark, path) == AFTER == read(spark, path)
    assert len(glob.glob(f"{path}/{pub.PUBLISHED}/*.json")) == 1 and not os.path.exists(f"{path}/_staged")


def test_the_older_of_two_loads_is_refused_and_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "gold")
    start = pub.head(spark, path)
    state = pub.publish(table(spark, OLD), path, "day", start)
    with pytest.raises(pub.TakenError):
        pub.publish(table(spark, NEW), path, "day", start)
    assert read(spark, path) == sorted(OLD, key=repr) == plain(spark, path)
    # a late settling of an old state spares the files of newer ones
    later = pub.publish(table(spark, NEW), path, "day", state)
    for s in (state, later, state):
        pub.settle(spark, path, s)
    assert read(spark, path) == AFTER == plain(spark, path)


def test_a_plain_table_is_taken_over(spark, tmp_path):
    path = str(tmp_path / "gold")
    table(spark, OLD).write.partitionBy("day").parquet(path)
    assert read(spark, path) == sorted(OLD, key=repr)
    state = pub.publish(table(spark, NEW), path, "day", pub.head(spark, path))
    assert read(spark, path) == AFTER
    pub.settle(spark, path, state)
    assert plain(spark, path) == AFTER


def test_one_of_many_writers_creates_a_file(spark, tmp_path):
    path = str(tmp_path / "claims" / "one.json")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: pub.put_if_absent(spark, path, str(i) * 50), range(8)))
        runs = list(pool.map(lambda i: Run.start(spark, str(tmp_path), "2024-02-01 00:00:00").run_seq, range(8)))
    assert sum(won) == 1 and pub.read_text(spark, path) == str(won.index(True)) * 50
    assert sorted(runs) == list(range(1, 9)) and os.listdir(tmp_path / "claims") == ["one.json"]


def test_merge_counts_equal_upsert_and_its_counts(spark):
    old = spark.createDataFrame([(i % 50, i % 4, i, "old") for i in range(40)], "k int, p int, o int, v string")
    new = spark.createDataFrame([(i % 30 if i % 3 else None, i % 5, i, f"n{i}") for i in range(300)], "k int, p int, o int, v string")
    merged = gold.merge(old.drop("o"), new, ["k", "p"], ["o"])
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(merged.select("k", "p", "v")) == rows(gold.upsert(old.drop("o"), new, ["k", "p"], ["o"]).select("k", "p", "v"))
    order = ["p", "source_rows", "distinct_keys", "inserted", "updated"]
    assert rows(gold.merge_counts(merged, "p").select(*order)) == rows(gold.upsert_counts(old, new, ["k", "p"], "p").select(*order))


def silver(spark, root, day, points):
    rows = [(i, f"P{i}", "T", "S", points, 1, 1, day, "2024-02-01", "f", 0, i) for i in range(5)]
    names = [*PLAYER_STATS.contract.names, "ingested_at", *ORDER_COLUMNS]
    df = spark.createDataFrame(rows, names).withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz"))
    df = df.withColumns({"snapshot_time_date": F.col("snapshot_time_date").cast("date"), "_src_block": F.col("_src_block").cast("bigint")})
    df.write.mode("overwrite").parquet(f"{root}/silver/snapshot_date={day}")


def points(spark, root):
    rows = spark.read.parquet(f"{root}/gold").groupBy(F.col("snapshot_time_date").cast("string")).agg(F.sum("points")).collect()
    return {r[0]: r[1] for r in rows}


def test_a_job_that_is_overtaken_merges_again_and_reads_silver_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    for i, day in enumerate(DAYS):
        silver(spark, root, day, i + 1)
    publish, reads, read_layer = pub.publish, [], jobs.read_layer
    monkeypatch.setattr(jobs, "read_layer", lambda *a: reads.append(a) or read_layer(*a))

    def overtaken(*args):
        monkeypatch.setattr(pub, "publish", publish)
        jobs.load_gold(spark, PLAYER_STATS, Run(root, "2024-02-02 00:00:00", 2), DAYS[:1], "v1")
        return publish(*args)
    monkeypatch.setattr(pub, "publish", overtaken)
    jobs.load_gold(spark, PLAYER_STATS, Run(root, "2024-02-03 00:00:00", 3), DAYS, "v1")
    assert points(spark, root) == {DAYS[0]: 5, DAYS[1]: 10}
    ledger = {r[0]: str(r[1]) for r in spark.read.parquet(f"{root}/ledger").collect()}
    assert ledger == {DAYS[0]: "2024-02-02 00:00:00", DAYS[1]: "2024-02-03 00:00:00"}
    assert len(reads) == 3                                   # once a merge


def test_a_job_that_dies_behind_the_publication_is_complete(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    silver(spark, root, DAYS[0], 1)
    with monkeypatch.context() as m:
        m.setattr(jobs, "_settle", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.load_gold(spark, PLAYER_STATS, Run(root, "2024-02-02 00:00:00", 1), DAYS[:1], "v1")
    assert not os.path.exists(f"{root}/ledger")
    assert [r[0] for r in jobs.read_ledger(spark, Run(root, "", 2)).collect()] == DAYS[:1]
    jobs.load_gold(spark, PLAYER_STATS, Run(root, "2024-02-03 00:00:00", 2), DAYS[:1], "v1")   # nothing is pending
    assert [str(r[1]) for r in spark.read.parquet(f"{root}/ledger").collect()] == ["2024-02-02 00:00:00"]


def contract(version, *names):
    return Contract(version, tuple(ContractColumn(n, "string") for n in names))


def test_two_writers_of_one_version_have_one_winner(spark, tmp_path):
    path = str(tmp_path / "registry")
    rows = lambda *names: contracts.contract_rows(spark, "d/ä", [contract("v2", *names)])
    layers.register_versions(contracts.contract_rows(spark, "d/ä", [contract("v1", "a")]), path)

    def write(names):
        try:
            layers.register_versions(rows(*names), path)
        except pub.TakenError as e:
            return str(e)
    with ThreadPoolExecutor(2) as pool:
        told = list(pool.map(write, [("a", "b"), ("a", "c")]))
    assert sorted(t is None for t in told) == [False, True] and "d/ä v2" in next(t for t in told if t)
    winner = ("a", "b") if told[0] is None else ("a", "c")
    newest = contracts.latest_contract(layers.read_registry(spark, path)).collect()
    assert sorted(r["name"] for r in newest) == sorted(winner)
    layers.register_versions(rows(*winner), path)             # the same contract again is no conflict
    assert layers.read_registry(spark, path).count() == 3 == spark.read.parquet(path).count()


def test_a_claim_counts_before_its_copy_and_an_older_table_wins(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "registry")
    contracts.contract_rows(spark, "d", [contract("v1", "a")]).write.parquet(path)
    with pytest.raises(pub.TakenError):
        layers.register_versions(contracts.contract_rows(spark, "d", [contract("v1", "b")]), path)
    assert [r["name"] for r in layers.read_registry(spark, path).collect()] == ["a"]
    put = pub.put_if_absent
    with monkeypatch.context() as m:
        m.setattr(layers, "put_if_absent", lambda *a: put(*a) and 1 / 0)
        with pytest.raises(ZeroDivisionError):
            layers.register_versions(contracts.contract_rows(spark, "d", [contract("v2", "a", "b")]), path)
    assert contracts.latest_versions(layers.read_registry(spark, path)).first()["version"] == "v2"
