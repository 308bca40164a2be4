"""State of several snapshots taken together against their rows, and distribution drift."""

import math
import random
import statistics

import numpy as np
import pytest

from snapgate.operators import drift, mergeable as mg, profile as pf


def pools(spark, rows):
    """Rows (day, value) as profiles of days, all put into one window."""
    return spark.createDataFrame(rows, "day string, x double")


def windowed(state):
    return state.withColumnRenamed("day", "member").selectExpr("'w' as day", "* except (member)")


CASES = {
    "mixed": [(f"d{i % 5}", random.Random(i).gauss(0, 10.0 ** (i % 7 - 3))) for i in range(3000)],
    "far_from_zero": [("a" if i % 2 else "b", 1e9 + i % 10) for i in range(1000)],
    "one_value": [("a", 5.0)] * 10 + [("b", 5.0)],
    "with_gaps": [("a", None), ("a", float("nan")), ("b", 2.0), ("b", -4.0), ("c", None)],
}


@pytest.mark.parametrize("case", CASES)
def test_pooled_moments_and_quantiles_of_a_window(spark, case):
    rows = CASES[case]
    values = [v for _, v in rows if v is not None and not math.isnan(v)]
    df = pools(spark, rows)
    r = mg.pooled_moments(windowed(pf.profile_numeric(df, ["x"], "day")), "day").first()
    assert r["rows"] == len(values) and r["pooled_mean"] == pytest.approx(statistics.fmean(values), rel=1e-12)
    assert r["pooled_std"] == pytest.approx(statistics.pstdev(values), rel=1e-6, abs=1e-9)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    found = mg.window_quantiles(windowed(mg.bucket_counts(df, ["x", "absent"], "day")), probs, "day").collect()
    assert sorted(f["prob"] for f in found) == probs
    for f in found:
        exact = float(np.quantile(values, f["prob"]))
        assert f["rows"] == len(values) and f["low"] <= exact <= f["high"]
        order = sorted(values)
        at = f["prob"] * (len(values) - 1)
        ends = order[math.floor(at)], order[math.ceil(at)]
        widest = max(abs(e) for e in ends) * (math.exp(1 / 64) - 1) * 1.001
        assert abs(f["value"] - exact) <= widest + 1e-12
        # few enough values lie between the bounds: the ranks they span are those of two buckets
        assert f["low"] >= ends[0] - abs(ends[0]) / 63 and f["high"] <= ends[1] + abs(ends[1]) / 63


def test_states_of_empty_windows(spark):
    empty = pools(spark, [])
    assert mg.pooled_moments(pf.profile_numeric(empty, ["x"], "day"), "day").collect() == []
    nulls = pools(spark, [("a", None)])
    r = mg.pooled_moments(pf.profile_numeric(nulls, ["x"], "day"), "day").first()
    assert (r["rows"], r["pooled_mean"], r["pooled_std"]) == (0, None, None)
    assert mg.window_quantiles(mg.bucket_counts(nulls, ["x"], "day"), [0.5], "day").collect() == []


def test_distinct_sketches_unite(spark):
    df = spark.range(40_000).selectExpr("concat('d', id % 4) as day", "id % 9000 as many", "id % 3 as few", "cast(null as string) as none")
    state = mg.distinct_sketches(df, ["many", "few", "none", "absent"], "day")
    assert max(len(r["distinct_sketch"]) for r in state.collect()) < 6000
    found = {r["column"]: r["distinct_values"] for r in mg.window_distinct(windowed(state), "day").collect()}
    assert abs(found["many"] - 9000) < 0.05 * 9000 and found["few"] == 3 and found["none"] == 0


def counts(spark, rows):
    return spark.createDataFrame([("d", "c", v, n) for v, n in rows], "day string, column string, value string, n long")


def one(spark, now, base):
    return drift.distribution_drift(counts(spark, now), counts(spark, base), by="day").collect()


def test_distribution_drift(spark):
    same = one(spark, [("a", 10), ("b", 30)], [("b", 3), ("a", 1)])[0]
    assert (same["js_distance"], same["psi"], same["new_values"], same["severity"]) == (pytest.approx(0, abs=1e-8), 0.0, 0, "INFO")
    apart = one(spark, [("a", 5)], [("b", 7)])[0]
    assert apart["js_distance"] == pytest.approx(1.0) and apart["severity"] == "CRITICAL"
    assert (apart["new_named"], apart["vanished_named"]) == (["a"], ["b"])
    now, base = [(f"n{i}", 100 - i) for i in range(9)] + [("k", 10)], [("k", 10), ("gone", 1)]
    r = one(spark, now, base)[0]
    p, q = {v: n / sum(n for _, n in now) for v, n in now}, {"k": 10 / 11, "gone": 1 / 11}
    m = {v: (p.get(v, 0) + q.get(v, 0)) / 2 for v in {*p, *q}}
    js = math.sqrt(sum(x[v] * math.log2(x[v] / m[v]) for x in (p, q) for v in x) / 2)
    psi = sum((max(p.get(v, 0), 1e-4) - max(q.get(v, 0), 1e-4)) * math.log(max(p.get(v, 0), 1e-4) / max(q.get(v, 0), 1e-4)) for v in m)
    assert r["js_distance"] == pytest.approx(js) and r["psi"] == pytest.approx(psi)
    assert (r["new_values"], r["new_named"], r["vanished_named"]) == (9, [f"n{i}" for i in range(5)], ["gone"])
    assert one(spark, [], [("a", 1)]) == [] == one(spark, [("a", 1)], [])
    assert one(spark, [("a", 0)], [("a", 1)]) == []


def test_a_profile_reads_its_rows_once_and_the_ranges_of_its_quantiles_again(spark):
    for rows, again in (([("a", 1.0), ("a", 3.0), ("a", 3.0)], 0), ([("a", 1.0 + i / 1e6) for i in range(99)], 1)):
        df = spark.createDataFrame(rows, "snapshot_date string, x double")
        plan = pf.profile_numeric(df, ["x"])._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LocalRelation") + plan.count("LogicalRDD") == again   # the bucket pass is stored


def test_jobs_store_window_statistics_exact_figures_and_distributions(spark, tmp_path):
    from test_jobs import D, LOOSE, player, run, write_raw
    from dataclasses import replace
    from snapgate.plans import jobs
    from snapgate.sources import metrics as mt
    root, cfg = str(tmp_path), replace(LOOSE, mergeable_profiles=True)
    values = {}
    for k, day in enumerate(D):
        values[day] = [(i * 7 + k) % 50 for i in range(30 + 10 * k)]
        write_raw(root, day, [player(i, day, team=f"T{(i + k) % 3 + k}", points=v) for i, v in enumerate(values[day])] + ([player(0, day, "T0" if not k else f"T{k % 3 + k}")] * 2))
    jobs.ingest(spark, cfg, run(root), D)
    jobs.validate_and_clean(spark, cfg, run(root), D)
    cleaned = {r["snapshot_date"]: (r["dropped_duplicates"], r["duplicated_keys"]) for r in mt.read_metrics(spark, f"{root}/metrics/cleaning", mt.CLEANING_METRIC).collect()}
    assert cleaned == {d: (2, 1) for d in D}
    jobs.check_quality(spark, replace(cfg, quality=replace(cfg.quality, row_count_change_pct=1e6)), run(root), D)
    changes = {r["snapshot_date"]: r["exact_row_count_change_pct"] for r in mt.read_metrics(spark, f"{root}/metrics/quality", mt.QUALITY_METRIC).collect()}
    assert changes[D[2]] == 25.0 and changes[D[1]] == pytest.approx(100 / 3, abs=1e-12)
    jobs.run_profiling(spark, cfg, run(root), D)
    jobs.build_baseline(spark, cfg, run(root), D)
    base = {(r["snapshot_date"], r["column"]): r["baseline"] for r in mt.read_metrics(spark, f"{root}/metrics/baseline", mt.BASELINE_METRIC).collect()}
    rows = values[D[0]] + values[D[1]]
    b = base[D[2], "points"]
    assert b["pooled_mean"] == pytest.approx(statistics.fmean(rows)) and b["pooled_std"] == pytest.approx(statistics.pstdev(rows))
    assert [b[f"window_p{p}"] for p in (25, 50, 75)] == pytest.approx([float(np.quantile(rows, p / 100)) for p in (25, 50, 75)], rel=0.02)
    assert base[D[2], "team"]["window_distinct"] == 4 and base[D[2], "season"]["window_distinct"] == 1
    jobs.detect_drift(spark, cfg, run(root), D)
    apart = {(r["snapshot_date"], r["column"]): r for r in mt.read_metrics(spark, f"{root}/metrics/distribution", mt.DISTRIBUTION_METRIC).collect()}
    team = apart[D[2], "team"]
    assert (team["new_named"], team["vanished_named"]) == (["T4"], ["T1", "T0"]) and team["severity"] == "CRITICAL"
    assert apart[D[2], "season"]["js_distance"] == 0.0
    exact = [r for r in mt.read_metrics(spark, f"{root}/metrics/drift", mt.DRIFT_METRIC).collect() if r["exact_drift_pct"]]
    assert exact and all(r["drift_pct"] == pytest.approx(r["exact_drift_pct"], abs=0.0051) for r in exact)
