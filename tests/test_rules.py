"""Rules over rows: one pass, exact verdicts, the violating rows set aside."""

import random

import pytest
from pyspark.sql import functions as F

from snapgate.operators import rules as rl
from snapgate.plans import jobs
from snapgate.sinks.scratch import cut_lineage
from snapgate.sources import metrics as mt
from test_jobs import D, LOOSE, alerts, day_lines, player, run, write_raw

COLUMNS = "day string, k int, g string, ref long, x double"


def build(spark, there):
    return [rl.Holds("positive", "x > 0"), rl.Holds("known", F.col("x") < 9, strict=True, limit_pct=60.0),
            rl.Unique("one k", ("k",)), rl.Unique("one pair", ("k", "g"), limit_pct=100.0),
            rl.References("ref", ("ref",), there, ("id",)), rl.References("pair", ("k", "g"), there, ("k2", "g2"))]


def brute(rows, there):
    ids, pairs = {r[0] for r in there}, {(r[1], r[2]) for r in there}
    verdicts = []
    for day, k, g, ref, x in rows:
        same = [r for r in rows if r[0] == day]
        verdicts.append((day, {
            "positive": x is not None and not x > 0, "known": x is None or not x < 9,
            "one k": k is not None and sum(r[1] == k for r in same) > 1,
            "one pair": k is not None and g is not None and sum(r[1:3] == (k, g) for r in same) > 1,
            "ref": ref is not None and ref not in ids, "pair": k is not None and g is not None and (k, g) not in pairs}))
    return verdicts


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    pick = lambda *v: rng.choice([*v, None])
    rows = [(pick("a", "b"), pick(*range(60)), pick("x", "y,", '"'), rng.choice([1, 2, 3, 9, None]), rng.choice([-1.0, 0.5, 20.0, None]))
            for _ in range(150)] + [("a", 7, "x", 1, 1.0)] * 40
    there = [(1, 7, "x"), (2, 8, "y,"), (2, 8, "y,"), (3, None, '"'), (None, 9, '"'), *((4, i, "x") for i in range(10, 40))]
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    ref = spark.createDataFrame(there, "id long, k2 int, g2 string")
    rules, verdicts = build(spark, ref), brute(rows, there)
    expected = {}
    for day, broken in verdicts:
        for name, bad in broken.items():
            n, v = expected.get((day, name), (0, 0))
            expected[day, name] = (n + 1, v + bad)
    limits = {r.name: r.limit_pct for r in rules}
    found = rl.check_rows(df, rules, "day").collect()
    assert {(r["day"], r["rule"]): (r["row_count"], r["violations"]) for r in found} == expected
    assert all((r["status"] == "FAILED") == (100 * r["violations"] / r["row_count"] > limits[r["rule"]]) for r in found)
    broken = cut_lineage(rl.broken_keys(cut_lineage(rl.key_counts(df, rules, "day")), rules, "day"))
    aside = rl.violating_rows(df, rules, broken, "day")
    assert aside.columns == [*df.columns, "_violations"]
    want = sorted(((*r, [n for n, bad in v.items() if bad]) for r, (_, v) in zip(rows, verdicts) if any(v.values())), key=repr)
    assert sorted(((*tuple(r)[:5], r["_violations"]) for r in aside.collect()), key=repr) == want


def test_one_scan_and_partial_aggregation(spark, tmp_path):
    spark.createDataFrame([("a", 1, "x", 1, 1.0)], COLUMNS).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    ref = spark.range(3).selectExpr("id", "int(id) as k2", "'x' as g2")
    plan = rl.key_counts(df, build(spark, ref), "day")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and plan.count("HashAggregate") == 2


def test_rules_without_violations_and_empty_tables(spark):
    rules = [rl.Holds("h", "x > 0"), rl.Unique("u", ("k",))]
    for rows, n in (([("a", 1, "x", 1, 1.0)], 2), ([], 0)):
        df = spark.createDataFrame(rows, COLUMNS)
        assert [r["status"] for r in rl.check_rows(df, rules, "day").collect()] == ["PASSED"] * n
        broken = cut_lineage(rl.broken_keys(cut_lineage(rl.key_counts(df, rules, "day")), rules, "day"))
        assert rl.violating_rows(df, rules, broken, "day").collect() == []
    with pytest.raises(ValueError, match="one name"):
        rl.check_rows(df, [rules[0], rl.Unique("h", ("k",))], "day")


def test_the_quality_job_sets_rows_aside_and_fails(spark, tmp_path):
    root = str(tmp_path)
    write_raw(root, D[0], [*day_lines(D[0]), player(3, D[0], "T9")])
    jobs.ingest(spark, LOOSE, run(root), D[:1])
    jobs.validate_and_clean(spark, LOOSE, run(root), D[:1])
    teams = spark.createDataFrame([(f"T{i}",) for i in range(3)], "t string")
    rules = [rl.References("known team", ("team",), teams, ("t",)), rl.Unique("one line a player", ("player_id", "season"), limit_pct=20.0)]
    with pytest.raises(jobs.GateFailed):
        jobs.check_quality(spark, LOOSE, run(root), D[:1], row_rules=rules)
    aside = spark.read.parquet(f"{root}/violations").collect()
    assert sorted((r["player_id"], r["team"], tuple(r["_violations"])) for r in aside) == [
        (3, "T0", ("one line a player",)), (3, "T9", ("known team", "one line a player"))]
    assert ("CRITICAL", "DATA_QUALITY", D[0], "Rule broken: known team") in alerts(spark, root)
    assert not any("one line" in a[3] for a in alerts(spark, root))
    jobs.check_quality(spark, LOOSE, run(root, 2), D[:1], row_rules=[rl.Holds("points", "points >= 0")])
    assert spark.read.parquet(f"{root}/violations").count() == 0
    stored = mt.read_metrics(spark, f"{root}/metrics/rules", mt.RULE_METRIC).collect()
    assert sorted((r["run_seq"], r["rule"], r["violations"], r["status"]) for r in stored) == [
        (1, "known team", 1, "FAILED"), (1, "one line a player", 2, "PASSED"), (2, "points", 0, "PASSED")]
