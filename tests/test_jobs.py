"""The jobs end to end on raw CSV folders: layers, gates, metrics, Gold, ledger, alerts."""

import glob
import json
import os
from dataclasses import replace

import pytest

from snapgate.config import PLAYER_STATS, Contract, ContractColumn, DriftLimits, QualityLimits
from snapgate.operators.contracts import contract_rows, latest_versions
from snapgate.plans import jobs
from snapgate.plans.jobs import GateFailed, Run
from snapgate.sources import metrics as mt
from snapgate.sources.raw import read_layer
from snapgate.sources.snapshots import list_snapshots
from snapgate.streaming.incremental import run_new_snapshots

D = ["2024-01-01", "2024-01-02", "2024-01-03"]
HEADER = "player_id,player_name,team,season,points,assists,rebounds,snapshot_time_date"
LOOSE = replace(PLAYER_STATS, numeric_drift=DriftLimits(1e6, 1e9), cardinality_drift=DriftLimits(1e6, 1e9))


def write_raw(root, day, lines, part="a"):
    folder = os.path.join(root, "raw", f"snapshot_date={day}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, f"{part}.csv"), "w") as f:
        f.write("\n".join([HEADER, *lines]) + "\n")


def player(i, day, team="T1", points=10, season="2023-24"):
    return f"{i},P{i},{team},{season},{points},{i % 5},{i % 7},{day}"


def day_lines(day, n=20, shift=0):
    return [player(i, day, team=f"T{i % 3}", points=i % 6 + shift) for i in range(n)]


@pytest.fixture
def root(tmp_path):
    r = str(tmp_path)
    for day in D:
        write_raw(r, day, day_lines(day))
    return r


def run(root, seq=1):
    return Run(root, f"2024-02-0{seq} 00:00:00", seq)


def alerts(spark, root):
    return [(r["severity"], r["source"], r["snapshot_date"], r["message"])
            for r in spark.read.schema(mt.ALERT).json(f"{root}/alerts").collect()]


def test_back_fill_in_one_run_equals_daily_runs(spark, tmp_path):
    tables = []
    for name in ("daily", "backfill"):
        root = str(tmp_path / name)
        for day in D:
            write_raw(root, day, day_lines(day))
        batches = [[d] for d in D] if name == "daily" else [D]
        for i, batch in enumerate(batches):
            jobs.run_all(spark, LOOSE, Run(root, "2024-02-01 00:00:00", i + 1), batch)
        tables.append(sorted(map(repr, spark.read.parquet(f"{root}/gold").collect())))
        profiles = mt.read_metrics(spark, f"{root}/metrics/profile", mt.PROFILE_METRIC)
        assert profiles.count() == 3 * 5
        base = mt.read_metrics(spark, f"{root}/metrics/baseline", mt.BASELINE_METRIC)
        assert {(r["snapshot_date"], r["history_snapshots"]) for r in base.collect()} == {(D[1], 1), (D[2], 2)}
        records = mt.read_metrics(spark, f"{root}/metrics/drift", mt.DRIFT_METRIC)
        assert records.count() == 2 * (3 * 8 + 2)
        assert {r["drift_pct"] for r in records.collect()} == {0.0}
        quality = mt.read_metrics(spark, f"{root}/metrics/quality", mt.QUALITY_METRIC).collect()
        assert sorted((r["snapshot_date"], r["row_count"], r["row_count_change_pct"], r["status"])
                      for r in quality) == [(D[0], 20, None, "PASSED"), (D[1], 20, 0.0, "PASSED"),
                                            (D[2], 20, 0.0, "PASSED")]
        assert quality[0]["null_percentages"] == {"player_id": 0.0, "points": 0.0, "season": 0.0}
        cards = mt.read_metrics(spark, f"{root}/metrics/schema", mt.SCHEMA_METRIC).collect()
        assert {(r["checks_passed"], r["checks_failed"], r["status"]) for r in cards} == {(4, 0, "PASSED")}
        ledger = spark.read.parquet(f"{root}/ledger").collect()
        assert sorted(r["snapshot_date"] for r in ledger) == D
    assert tables[0] == tables[1] and len(tables[0]) == 60


def test_latest_snapshot_by_default_and_missing_ones(spark, root):
    assert jobs.ingest(spark, PLAYER_STATS, run(root)) == [D[2]]
    with pytest.raises(FileNotFoundError, match="2030-01-01"):
        jobs.ingest(spark, PLAYER_STATS, run(root), ["2030-01-01"])
    with pytest.raises(FileNotFoundError):
        jobs.validate_and_clean(spark, PLAYER_STATS, run(root), [D[0]])
    with pytest.raises(FileNotFoundError):
        jobs.check_quality(spark, PLAYER_STATS, run(root), [D[2]])


def test_cleaning_keeps_the_first_file_position_and_leaves_other_partitions(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root, D[0], [player(1, D[0], points=11), player(1, D[0], points=22), player(2, D[0], points="NA"),
                           player(3, D[0], points=7.0)], "a")
    write_raw(root, D[0], [player(1, D[0], points=33), player(4, D[0])], "b")
    write_raw(root, D[1], day_lines(D[1]))
    jobs.ingest(spark, PLAYER_STATS, run(root), D[:2])
    jobs.validate_and_clean(spark, PLAYER_STATS, run(root), D[:2])
    silver = spark.read.parquet(f"{root}/silver")
    got = {(r["player_id"], r["points"]) for r in silver.where(f"snapshot_date = '{D[0]}'").collect()}
    assert got == {(1, 11), (3, 7), (4, 10)}
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{root}/silver/snapshot_date={D[1]}/*")}
    jobs.validate_and_clean(spark, PLAYER_STATS, run(root), D[:1])
    assert before == {p: os.path.getmtime(p) for p in glob.glob(f"{root}/silver/snapshot_date={D[1]}/*")}


def test_malformed_value_fails_or_is_set_aside(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root, D[0], [player(1, D[0]), player(2, D[0], points="abc")])
    jobs.ingest(spark, PLAYER_STATS, run(root), D[:1])
    with pytest.raises(Exception, match="points: cannot convert abc"):
        jobs.validate_and_clean(spark, PLAYER_STATS, run(root), D[:1])
    jobs.validate_and_clean(spark, PLAYER_STATS, run(root), D[:1], on_bad_cast="drop")
    assert [r["player_id"] for r in spark.read.parquet(f"{root}/silver").collect()] == [1]
    rejects = spark.read.parquet(f"{root}/rejects").collect()
    assert [(r["player_id"], r["_rejects"]) for r in rejects] == [("2", ["points"])]


def prepare(spark, root, days=D):
    jobs.ingest(spark, PLAYER_STATS, run(root), days)
    jobs.validate_and_clean(spark, PLAYER_STATS, run(root), days)


def test_contract_evolution(spark, root):
    prepare(spark, root)
    contract_rows(spark, "player_stats", [PLAYER_STATS.contract]).write.parquet(f"{root}/registry")
    cols = PLAYER_STATS.contract.columns
    wider = replace(PLAYER_STATS, contract=Contract("v1", (*cols, ContractColumn("league", "string"))))
    # a new nullable column is compatible, but the data lacks it: nothing is registered
    with pytest.raises(GateFailed):
        jobs.enforce_schema(spark, wider, run(root), D)
    assert latest_versions(spark.read.parquet(f"{root}/registry")).first()["version"] == "v1"
    with_it = replace(PLAYER_STATS, contract=Contract("v1", (*cols, ContractColumn("snapshot_date", "date"))))
    assert jobs.enforce_schema(spark, with_it, run(root, 2), D) == "v2"
    assert latest_versions(spark.read.parquet(f"{root}/registry")).first()["version"] == "v2"
    assert jobs.enforce_schema(spark, with_it, run(root, 3), D) == "v2"
    with pytest.raises(GateFailed):
        jobs.enforce_schema(spark, PLAYER_STATS, run(root, 4), D)  # the column is gone again
    last = mt.latest_record(mt.read_metrics(spark, f"{root}/metrics/schema", mt.SCHEMA_METRIC),
                            ["snapshot_date"], ["run_seq"]).collect()
    assert {(r["checks_passed"], r["status"]) for r in last} == {(0, "FAILED")}
    found = alerts(spark, root)
    assert ("INFO", "SCHEMA_CHECK", D[2], "New schema version registered: v2") in found
    assert ("CRITICAL", "SCHEMA_CHECK", D[2], "Breaking schema change detected") in found
    details = spark.read.schema(mt.ALERT).json(f"{root}/alerts").where("message like 'Breaking%'").first()["details"]
    assert json.loads(details) == {"dataset": "player_stats", "issues": ["Column removed: snapshot_date"]}


def test_quality_gate_warns_and_fails_after_writing(spark, root):
    write_raw(root, D[2], day_lines(D[2], n=40))
    prepare(spark, root)
    jobs.check_quality(spark, PLAYER_STATS, run(root), D)
    assert alerts(spark, root) == [("WARN", "DATA_QUALITY", D[2], "Row count drift detected")]
    # a re-run compares with the day before, or with its own record
    jobs.check_quality(spark, PLAYER_STATS, run(root, 2), [D[2]])
    jobs.check_quality(spark, PLAYER_STATS, run(root, 3), [D[2]], compare_with="latest_record")
    history = mt.read_metrics(spark, f"{root}/metrics/quality", mt.QUALITY_METRIC).where(f"snapshot_date = '{D[2]}'")
    assert {r["run_seq"]: (r["row_count_change_pct"], r["status"]) for r in history.collect()} == {
        1: (100.0, "WARN"), 2: (100.0, "WARN"), 3: (0.0, "PASSED")}
    strict = replace(PLAYER_STATS, quality=QualityLimits(30.0, 5.0, ("player_id", "height")))
    with pytest.raises(GateFailed, match=D[0]):
        jobs.check_quality(spark, strict, run(root, 4), [D[0]])
    assert history.sparkSession.read.schema(mt.QUALITY_METRIC).json(f"{root}/metrics/quality").where(
        "run_seq = 4").first()["status"] == "FAILED"


def test_drift_gate(spark, root):
    write_raw(root, D[2], day_lines(D[2], shift=4))
    prepare(spark, root)
    jobs.run_profiling(spark, PLAYER_STATS, run(root), D)
    jobs.build_baseline(spark, PLAYER_STATS, run(root), D)
    jobs.detect_drift(spark, PLAYER_STATS, run(root), D[:1])   # bootstrap passes
    with pytest.raises(GateFailed, match=D[2]):
        jobs.detect_drift(spark, PLAYER_STATS, run(root), D)
    line = json.loads(open(glob.glob(f"{root}/metrics/drift/snapshot_date={D[2]}/*.json")[0]).readline())
    assert {"layer", "column", "metric", "baseline", "current", "drift_pct", "severity", "timestamp"} <= set(line)
    with pytest.raises(FileNotFoundError):
        jobs.detect_drift(spark, PLAYER_STATS, run(root), ["2024-05-05"])


def test_gold_is_idempotent_last_wins_and_forced_corrections(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root, D[0], [player(1, D[0], "T1", 5), player(1, D[0], "T2", 6), player(2, D[0], "T1", 7)])
    write_raw(root, D[1], [player(1, D[1], "T9", 1)])
    prepare(spark, root, D[:2])
    jobs.load_gold(spark, PLAYER_STATS, run(root), D[:2], "v1")

    def gold():
        return sorted((str(r["snapshot_time_date"]), r["player_id"], r["team"], r["points"], r["schema_version"])
                      for r in spark.read.parquet(f"{root}/gold").collect())
    want = [(D[0], 1, "T2", 6, "v1"), (D[0], 2, "T1", 7, "v1"), (D[1], 1, "T9", 1, "v1")]
    assert gold() == want
    untouched = {p: os.path.getmtime(p) for p in glob.glob(f"{root}/gold/snapshot_time_date={D[1]}/*")}
    write_raw(root, D[0], [player(2, D[0], "T1", 70), player(3, D[0], "T1", 8)])
    prepare(spark, root, D[:1])
    jobs.load_gold(spark, PLAYER_STATS, run(root, 2), D[:1], "v2")           # in the ledger: skipped
    assert gold() == want
    for _ in range(2):
        jobs.load_gold(spark, PLAYER_STATS, run(root, 3), D[:1], "v2", force=True)
    assert gold() == [(D[0], 1, "T2", 6, "v1"), (D[0], 2, "T1", 70, "v2"), (D[0], 3, "T1", 8, "v2"),
                      (D[1], 1, "T9", 1, "v1")]
    assert untouched == {p: os.path.getmtime(p) for p in glob.glob(f"{root}/gold/snapshot_time_date={D[1]}/*")}
    assert spark.read.parquet(f"{root}/ledger").count() == 2
    found = alerts(spark, root)
    assert ("INFO", "GOLD_LOADER", D[0], "Snapshot already processed — skipping Gold load") in found
    assert found.count(("INFO", "GOLD_LOADER", D[0], "Gold load completed successfully")) == 3


def test_empty_silver_is_not_marked_processed(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root, D[0], [player(1, D[0], points="NA")])
    write_raw(root, D[1], [player(1, D[1])])
    prepare(spark, root, D[:2])
    jobs.load_gold(spark, PLAYER_STATS, run(root), D[:2], "v1")
    assert [r["snapshot_date"] for r in spark.read.parquet(f"{root}/ledger").collect()] == [D[1]]
    assert ("WARN", "GOLD_LOADER", D[0], "Silver dataset is empty — no rows loaded") in alerts(spark, root)
    with pytest.raises(FileNotFoundError):
        jobs.load_gold(spark, PLAYER_STATS, run(root), ["2024-09-09"], "v1")
    assert ("CRITICAL", "GOLD_LOADER", "2024-09-09", "Gold load failed") in alerts(spark, root)
    with pytest.raises(FileNotFoundError):
        jobs.enforce_schema(spark, PLAYER_STATS, run(root), ["2024-09-09"])
    card = mt.read_metrics(spark, f"{root}/metrics/schema", mt.SCHEMA_METRIC).first()
    assert (card["snapshot_date"], card["checks_passed"], card["status"]) == ("2024-09-09", 1, "FAILED")


def test_csv_layers(spark, root):
    cfg = replace(LOOSE, layer_format="csv")
    write_raw(root, D[0], [player(i, D[0], team=t, points=p) for i in range(12) for t, p in (("A", 1), ("B", i))])
    jobs.run_all(spark, cfg, run(root), D)
    gold = spark.read.parquet(f"{root}/gold")
    assert gold.count() == 52 and dict(gold.dtypes)["player_id"] == "bigint"
    assert dict(gold.dtypes)["ingested_at"] == "timestamp_ntz"
    last = gold.where(f"snapshot_time_date = '{D[0]}'").select("player_id", "team", "points").collect()
    assert sorted(map(tuple, last)) == [(i, "B", i) for i in range(12)]
    assert glob.glob(f"{root}/silver/snapshot_date={D[0]}/*.csv")


def test_a_snapshot_that_loses_all_rows_is_emptied(spark, tmp_path):
    root = str(tmp_path)
    for day in D[:2]:
        write_raw(root, day, day_lines(day))
    prepare(spark, root, D[:2])
    write_raw(root, D[0], [player(1, D[0], points="NA")])
    jobs.ingest(spark, PLAYER_STATS, run(root, 2), D[:1])
    assert jobs.validate_and_clean(spark, PLAYER_STATS, run(root, 2), D[:2]) == [D[0]]
    assert spark.read.parquet(f"{root}/silver").count() == 20
    assert jobs.enforce_schema(spark, PLAYER_STATS, run(root, 2), D[:2]) == "v1"
    jobs.check_quality(spark, PLAYER_STATS, run(root, 2), D[:1])
    record = mt.read_metrics(spark, f"{root}/metrics/quality", mt.QUALITY_METRIC).first()
    assert (record["row_count"], record["status"]) == (0, "PASSED")


def test_new_snapshots_are_processed_once(spark, tmp_path):
    root, checkpoint = str(tmp_path / "lake"), str(tmp_path / "checkpoint")
    seen = []

    def job(spark, cfg, run, snapshots):
        seen.append((run.run_seq, list(snapshots)))
        jobs.ingest(spark, cfg, run, snapshots)

    for days in (D[:2], [], D[2:]):
        for day in days:
            write_raw(root, day, day_lines(day))
        run_new_snapshots(spark, PLAYER_STATS, root, checkpoint, "2024-02-01 00:00:00", job=job)
    assert [s for _, s in seen] == [D[:2], D[2:]] and seen[0][0] < seen[1][0]
    assert spark.read.parquet(f"{root}/bronze").count() == 60


def test_layers_read_only_the_given_snapshots(spark, root):
    prepare(spark, root)
    one = read_layer(spark, f"{root}/silver", "parquet", D[:1])
    assert one.count() == 20 and len(one.inputFiles()) < len(spark.read.parquet(f"{root}/silver").inputFiles())
    assert sorted(r[0] for r in list_snapshots(spark, f"{root}/silver").collect()) == D
    assert list_snapshots(spark, f"{root}/silver", [D[1], "2031-01-01"]).collect()[0][0] == D[1]
    assert list_snapshots(spark, f"{root}/nowhere").count() == 0


def test_profiling_skips_absent_columns(spark, root):
    prepare(spark, root, D[:1])
    cfg = replace(PLAYER_STATS, numeric_columns=("height",), categorical_columns=("team", "club"))
    jobs.run_profiling(spark, cfg, run(root), D[:1])
    records = mt.read_metrics(spark, f"{root}/metrics/profile", mt.PROFILE_METRIC).collect()
    assert [(r["column"], r["type"], r["metrics"]["cardinality"]) for r in records] == [("team", "categorical", 3)]


def test_run_all_on_a_snapshot_that_loses_all_rows(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root, D[0], [f",P1,T1,S1,1,1,1,{D[0]}"])
    jobs.run_all(spark, PLAYER_STATS, run(root), [D[0]])
    assert [(a[0], a[1]) for a in alerts(spark, root)] == [("WARN", "GOLD_LOADER")]
    assert not os.path.exists(f"{root}/ledger")
    assert {r["metrics"]["count"] for r in mt.read_metrics(spark, f"{root}/metrics/profile", mt.PROFILE_METRIC).collect()} == {0}


def test_a_good_duplicate_outlives_a_refused_row_and_old_rejects_go(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root, D[0], [player(1, D[0], points="abc"), player(1, D[0], points=7)])
    jobs.ingest(spark, PLAYER_STATS, run(root), [D[0]])
    jobs.validate_and_clean(spark, PLAYER_STATS, run(root), [D[0]], on_bad_cast="drop")
    assert [r["points"] for r in read_layer(spark, f"{root}/silver").collect()] == [7]
    assert [r["points"] for r in spark.read.parquet(f"{root}/rejects").collect()] == ["abc"]
    write_raw(root, D[0], [player(1, D[0], points=8)])
    jobs.ingest(spark, PLAYER_STATS, run(root, 2), [D[0]])
    jobs.validate_and_clean(spark, PLAYER_STATS, run(root, 2), [D[0]], on_bad_cast="drop")
    assert read_layer(spark, f"{root}/rejects").count() == 0
    counts = mt.read_metrics(spark, f"{root}/metrics/cleaning", "snapshot_date string, rows_in bigint, rows_after_dedup bigint, run_seq bigint")
    assert sorted((r["run_seq"], r["rows_in"], r["rows_after_dedup"]) for r in counts.collect()) == [(1, 1, 1), (2, 1, 1)]


def test_a_header_only_file_empties_bronze(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root, D[0], day_lines(D[0]))
    jobs.ingest(spark, PLAYER_STATS, run(root), [D[0]])
    write_raw(root, D[0], [])
    jobs.ingest(spark, PLAYER_STATS, run(root, 2), [D[0]])
    assert read_layer(spark, f"{root}/bronze").count() == 0


def test_all_missing_snapshots_are_named(spark, root):
    days = [f"2023-05-{d:02d}" for d in range(1, 12)]
    with pytest.raises(FileNotFoundError) as e:
        jobs.ingest(spark, PLAYER_STATS, run(root), days)
    assert all(d in str(e.value) for d in days)


def test_parquet_types_must_be_the_contracts(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root, D[0], day_lines(D[0]))
    jobs.ingest(spark, PLAYER_STATS, run(root), [D[0]])
    jobs.validate_and_clean(spark, PLAYER_STATS, run(root), [D[0]])
    silver = read_layer(spark, f"{root}/silver")
    for kind in ("string", "int"):
        silver.withColumn("points", silver.points.cast(kind)).drop("snapshot_date").coalesce(1).write.mode("overwrite").parquet(
            f"{root}/other-{kind}/silver/snapshot_date={D[0]}")
        with pytest.raises(GateFailed):
            jobs.enforce_schema(spark, PLAYER_STATS, run(f"{root}/other-{kind}"), [D[0]])
    jobs.enforce_schema(spark, PLAYER_STATS, run(root), [D[0]])


def test_long_lines_fail_and_quoted_line_ends_come_back_whole(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root, D[0], [player(1, D[0]), player(2, D[0]) + ",beyond", player(3, D[0])])
    with pytest.raises(Exception, match="too many cells"):
        jobs.ingest(spark, PLAYER_STATS, run(root), [D[0]])
    write_raw(root, D[0], [player(1, D[0]).replace("P1", '"P\n1"'), player(2, D[0])])
    jobs.ingest(spark, replace(PLAYER_STATS, raw_multi_line=True), run(root), [D[0]])
    assert sorted(r["player_name"] for r in read_layer(spark, f"{root}/bronze").collect()) == ["P\n1", "P2"]


def test_baselines_read_only_their_windows(spark, tmp_path):
    root, days = str(tmp_path), [f"2024-03-{d:02d}" for d in range(1, 13)]
    for day in days:
        write_raw(root, day, day_lines(day))
    jobs.ingest(spark, LOOSE, run(root), days)
    jobs.validate_and_clean(spark, LOOSE, run(root), days)
    jobs.run_profiling(spark, LOOSE, run(root), days)
    read = jobs._members(jobs._recorded(spark, f"{root}/metrics/profile"), [days[-1]], 7)
    assert read == set(days[4:11])
    files = jobs._profiles(spark, run(root), sorted(read)).inputFiles()
    assert {f.split("snapshot_date=")[1][:10] for f in files} == read


def test_value_counts_are_made_once(spark):
    from snapgate.operators import profile as pf
    df = spark.createDataFrame([("d", "a"), ("d", "b"), ("d", None)], "snapshot_date string, g string")
    plan = pf.profile_categorical(df, ["g"])._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "LogicalRDD" not in plan   # only the stored counts are read
