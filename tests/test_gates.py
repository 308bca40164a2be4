"""Contract diff, schema gate, quality, drift and baselines: hand-built edge cases."""

import pytest
from pyspark.sql import functions as F

from snapgate.config import Contract, ContractColumn, DriftLimits, QualityLimits
from snapgate.functions.measures import pct_change, pct_drift, severity, two_places
from snapgate.operators import baseline as bl, contracts as ct, drift, profile as pf, quality as dq
from snapgate.operators import schema_gate as sg
from snapgate.operators.quantiles import select_quantiles


def contract(version, *cols):
    return Contract(version, tuple(ContractColumn(*c) for c in cols))


def rows(df, *cols):
    return sorted([tuple(r) for r in (df.select(*cols) if cols else df).collect()], key=repr)


def diff(spark, old, new):
    a, b = (ct.contract_rows(spark, "d", [x]) for x in (old, new))
    return rows(ct.diff_contracts(a, b), "name", "kind", "change")


def test_diff_kinds(spark):
    old = contract("v1", ("a", "integer", False), ("b", "string"), ("c", "date", False), ("r", "string", False))
    new = contract("v2", ("b", "integer", False), ("c", "date", True), ("n", "string"), ("q", "date", False),
                   ("R", "string", False))
    assert diff(spark, old, new) == sorted([
        ("a", "breaking", "Column removed: a"),
        ("b", "breaking", "Nullable → non-nullable: b"),
        ("b", "breaking", "Type change: b (string → integer)"),
        ("c", "relaxed", "Non-nullable → nullable: c"),
        ("n", "compatible", "New nullable column: n"),
        ("q", "breaking", "New non-nullable column: q"),
        ("r", "breaking", "Column removed: r"),
        ("R", "breaking", "New non-nullable column: R")], key=repr)
    assert diff(spark, old, old) == []


def test_unknown_type_is_refused():
    with pytest.raises(ValueError, match="decimal"):
        ContractColumn("x", "decimal")


def test_nullable_by_default():
    c = Contract.from_dict({"version": "v1", "columns": [{"name": "a", "type": "string"},
                                                         {"name": "b", "type": "date", "nullable": False}]})
    assert c.critical == ["b"] and c.struct()["a"].nullable


def test_version_ten_is_newer_than_nine_and_gate_actions(spark):
    base = [("a", "integer", False)]
    registry = ct.contract_rows(spark, "d", [contract(f"v{i}", *base) for i in (9, 10, 2)])
    assert rows(ct.latest_versions(registry)) == [("d", "v10")]
    assert rows(ct.latest_versions(ct.previous_contract(registry)))[0] == ("d", "v9")
    latest = ct.latest_contract(registry)

    def act(*cols):
        incoming = ct.contract_rows(spark, "d", [contract("v1", *cols)])
        r = ct.gate_actions(latest, incoming).first()
        return r["action"], r["effective_version"], ct.rows_to_register(latest, incoming).count()

    assert act(*base) == ("pass", "v10", 0)
    assert act(*base, ("n", "string", True)) == ("register", "v11", 2)
    assert act(("a", "string", False)) == ("abort", "v10", 0)
    assert act(*base, ("n", "string", True), ("m", "string", False)) == ("abort", "v10", 0)


def test_presence_and_types_of_a_dataframe(spark):
    df = spark.createDataFrame([(1, "x", [1.0])], "a int, b string, e array<float>")
    want = ct.contract_rows(spark, "d", [contract("v1", ("a", "integer"), ("b", "date"), ("m", "string"))])
    have = sg.actual_columns(spark, df.withColumn("a", F.col("a").cast("bigint")), "d")
    assert rows(sg.missing_columns(want, have), "name") == [("m",)]
    assert rows(sg.extra_columns(want, have), "name", "type") == [("e", "array<float>")]
    assert rows(sg.type_mismatches(want, have), "name", "expected_type", "actual_type") == [("b", "date", "string")]


def test_scorecard_stops_at_the_first_failure(spark):
    c = contract("v3", ("a", "integer", False), ("d", "date"))
    df = spark.createDataFrame([("s1", "1", "2024-01-01"), ("s2", "x", None), ("s3", None, "2024-01-01"),
                                ("s4", "12.0", "2024-01-01"), ("s5", "5", "2024-13-01")],
                               "snapshot_date string, a string, d string")
    got = rows(sg.scorecard(df, c), "snapshot_date", "checks_passed", "checks_failed", "status")
    assert got == [("s1", 4, 0, "PASSED"), ("s2", 2, 1, "FAILED"), ("s3", 3, 1, "FAILED"),
                   ("s4", 2, 1, "FAILED"), ("s5", 2, 1, "FAILED")]
    assert {r[0] for r in rows(sg.scorecard(df.drop("d"), c), "checks_passed")} == {1}
    assert {r[0] for r in rows(sg.scorecard(df, c, evolution_ok=False), "checks_passed")} == {0}
    physical = spark.createDataFrame([("s", 1.0, None)], "snapshot_date string, a double, d date")
    assert rows(sg.scorecard(physical, c), "checks_passed", "uncastable_columns") == [(2, ["a"])]
    both = sg.scorecard(df, c, snapshots=spark.createDataFrame([("s1",), ("s9",)], "snapshot_date string"))
    assert rows(both, "snapshot_date", "row_count", "status") == [("s1", 1, "PASSED"), ("s9", 0, "PASSED")]


LIMITS = QualityLimits(30.0, 5.0, ("a",))


def status(spark, counts, limits=LIMITS, **kw):
    df = spark.createDataFrame(counts, "snapshot_date string, row_count bigint, nulls_a bigint")
    return {r["snapshot_date"]: (r["status"], r["reasons"])
            for r in dq.quality_status(dq.row_count_change(df), limits, **kw).collect()}


def test_quality_limits_are_strict_and_failed_outranks_warn(spark):
    got = status(spark, [("1", 100, 0), ("2", 130, 0), ("3", 200, 0), ("4", 200, 10), ("5", 100, 6)])
    assert {k: v[0] for k, v in got.items()} == {
        "1": "PASSED", "2": "PASSED", "3": "WARN", "4": "PASSED", "5": "FAILED"}
    assert got["5"][1] == ["nulls:a", "row count"]


def test_quality_zero_previous_missing_column_empty_snapshot_and_rules(spark):
    assert status(spark, [("1", 0, 0), ("2", 5, 0)]) == {
        "1": ("PASSED", []), "2": ("FAILED", ["previous count is zero"])}
    assert status(spark, [("1", 5, 0)], QualityLimits(30, 5, ("a", "zz")))["1"] == ("FAILED", ["missing:zz"])
    assert status(spark, [("1", 5, 0)], rules={"enough": F.col("row_count") >= 10})["1"] == (
        "FAILED", ["rule:enough"])


def test_latest_record_may_be_the_snapshot_itself(spark):
    # 174,719 against the same snapshot's earlier 174,835 is 0.07 percent; 174,835 against 174,617 is 0.12
    history = spark.createDataFrame(
        [("d", "2025-12-30", 1, 174617), ("d", "2025-12-31", 1, 174835)],
        "dataset string, snapshot_date string, run_seq int, row_count bigint")
    now = spark.createDataFrame([("d", 174719)], "dataset string, row_count bigint")
    got = dq.row_count_change_from_history(now, history).select(two_places(F.col("row_count_change_pct")))
    assert got.first()[0] == 0.07
    first = dq.row_count_change_from_history(spark.createDataFrame([("d", 174835)], now.schema),
                                             history.where("snapshot_date = '2025-12-30'"))
    assert first.select(two_places(F.col("row_count_change_pct"))).first()[0] == 0.12


def test_pct_functions(spark):
    def val(col):
        return spark.range(1).select(col).first()[0]
    d = lambda a, b, **k: val(pct_drift(F.lit(a), F.lit(b), **k))
    assert d(5.0, 0.0) == 0.0 and d(5.0, 0.0, zero_baseline="critical") == float("inf")
    assert d(-12.0, -10.0) == -20.0 and d(-12.0, -10.0, denominator="abs") == 20.0
    assert d(float("nan"), 10.0) is None
    assert val(pct_change(F.lit(5), F.lit(0))) is None and val(pct_change(F.lit(12), F.lit(10))) == 20.0
    assert [val(severity(F.lit(x), 10, 30)) for x in (9.99, 10.0, 29.9, 30.0, -50.0, None)] == [
        "INFO", "WARN", "WARN", "CRITICAL", "INFO", "INFO"]
    assert [val(two_places(F.lit(x))) for x in (0.125, 0.375, 7.6923)] == [0.12, 0.38, 7.69]


def test_profile_edge_cases(spark):
    df = spark.createDataFrame(
        [("d1", 1.0, "a"), ("d1", 2.0, "b"), ("d1", float("nan"), "b"), ("d2", 5.0, None), ("d3", None, "c")],
        "snapshot_date string, x double, g string")
    for small in (10, 0):
        got = {r["snapshot_date"]: r for r in pf.profile_numeric(df, ["x", "absent"], sort_rows=small).collect()}
        assert [got["d1"][m] for m in pf.NUMERIC_METRICS] == [2, 1.5, 1.5, 0.5, 1.0, 2.0, 1.25, 1.5, 1.75]
        assert [got["d2"][m] for m in pf.NUMERIC_METRICS] == [1, 5.0, 5.0, 0.0, 5.0, 5.0, 5.0, 5.0, 5.0]
        assert [got["d3"][m] for m in pf.NUMERIC_METRICS] == [0, None, None, 0.0] + [None] * 5
    cat = {r["snapshot_date"]: r for r in pf.profile_categorical(df, ["g"]).collect()}
    assert tuple(cat["d1"])[2:] == (3, 2, {"b": 2, "a": 1})
    assert tuple(cat["d2"])[2:] == (0, 0, {})
    assert rows(pf.missing_profile_columns(df, ["x", "absent"]), "snapshot_date", "column") == [
        ("d1", "absent"), ("d2", "absent"), ("d3", "absent")]


@pytest.mark.parametrize("sort_rows", [0, 50, 100_000])
def test_quantiles_by_narrowing_on_skewed_values(spark, sort_rows):
    """One value holds a third of the rows, one is huge, some are negative, zero or infinite."""
    import numpy as np
    rng = np.random.default_rng(7)
    data = {"hot": np.concatenate([np.full(3000, 42.0), rng.normal(0, 1e-3, 3000), rng.lognormal(0, 9, 3000),
                                   [1e300, -1e300, 0.0, -0.0]]),
            "near": 1.7e9 + rng.random(5000) * 1e-2, "neg": -rng.lognormal(3, 2, 2001), "one": np.array([3.5])}
    df = spark.createDataFrame([(k, float(v)) for k, vs in data.items() for v in vs], "k string, x double")
    probs = [0.0, 0.1, 0.25, 1 / 3, 0.5, 0.75, 0.999, 1.0]
    got = {(r["k"], r["prob"]): r["value"] for r in select_quantiles(df, ["k"], ["x"], probs, sort_rows).collect()}
    for k, vs in data.items():
        for p in probs:
            assert got[k, p] == pytest.approx(np.quantile(vs, p), rel=1e-9, abs=1e-12), (k, p)
    inf = spark.createDataFrame([("i", x) for x in (float("-inf"), 1.0, 2.0, float("inf"))], "k string, x double")
    got = {r["prob"]: r["value"] for r in select_quantiles(inf, ["k"], ["x"], [0.0, 1 / 3, 1.0], sort_rows).collect()}
    assert got[0.0] == float("-inf") and got[1.0] == float("inf") and got[1 / 3] == pytest.approx(1.0)


def test_top_values_break_ties_by_value(spark):
    df = spark.createDataFrame([("d", v) for v in "ffeeddccbbaa"], "snapshot_date string, g string")
    top = pf.top_values(pf.value_counts(df, ["g"]), 5)
    assert rows(top, "rank", "value") == [(i + 1, v) for i, v in enumerate("abcde")]


def num_profile(spark, days):
    data = [(d, "x", 10, m, m, 1.0, m - 1, m + 1, m, m, m) for d, m in days]
    return spark.createDataFrame(data, "snapshot_date string, column string, count bigint, mean double, "
                                       "median double, std double, min double, max double, p25 double, "
                                       "p50 double, p75 double")


def test_baseline_window_of_seven_with_gaps(spark):
    days = [f"2024-01-{d:02d}" for d in (1, 2, 3, 5, 8, 9, 10, 11, 20)]
    p = num_profile(spark, [(d, float(i)) for i, d in enumerate(days)])
    members = bl.window_members(p)
    got = {}
    for d, m in rows(members, "snapshot_date", "member"):
        got.setdefault(d, []).append(m)
    assert "2024-01-01" not in got and got["2024-01-20"] == days[1:8] and got["2024-01-11"] == days[:7]
    assert rows(bl.previous_snapshots(p, "2024-01-11", 3), "snapshot_date") == [
        ("2024-01-08",), ("2024-01-09",), ("2024-01-10",)]
    folded = bl.numeric_baseline(bl.history_of(p, members))
    assert rows(folded) == rows(bl.rolling_baseline(p).select(*folded.columns))
    last = folded.where("snapshot_date = '2024-01-20'").first()
    assert (last["mean"], last["median"], last["min"], last["max"], last["history_snapshots"]) == (4.0, 4.0, 0.0, 8.0, 7)


def test_snapshot_without_profile_uses_a_place(spark):
    days = [f"2024-01-{d:02d}" for d in range(1, 10)]
    known = spark.createDataFrame([(d,) for d in days], "snapshot_date string")
    p = num_profile(spark, [(d, 1.0) for d in days if d != "2024-01-05"])
    hist = bl.numeric_baseline(bl.history_of(p, bl.window_members(known)))
    assert {r[0]: r[1] for r in rows(hist, "snapshot_date", "history_snapshots")}["2024-01-09"] == 6


def test_categorical_baseline_averages_only_where_seen(spark):
    p = spark.createDataFrame([("1", "g", 3, {"a": 10, "b": 4}), ("2", "g", 4, {"a": 20, "c": 2})],
                              "snapshot_date string, column string, cardinality bigint, top_5_values map<string,bigint>")
    members = spark.createDataFrame([("3", "1"), ("3", "2")], "snapshot_date string, member string")
    b = bl.categorical_baseline(bl.history_of(p, members)).first()
    assert (b["avg_cardinality"], b["top_values"], b["seen_values"], b["history_snapshots"]) == (
        3.5, {"a": 15.0, "b": 4.0, "c": 2.0}, ["a", "b", "c"], 2)


def test_drift_golden_values_and_gate(spark):
    now, past = num_profile(spark, [("2", 12.0)]), num_profile(spark, [("1", 13.0)])
    base = past.drop("count").withColumn("snapshot_date", F.lit("2"))
    d = {r["metric"]: r for r in drift.numeric_drift(now, base).collect()}
    assert "count" not in d and len(d) == 8
    assert round(d["median"]["drift_pct"], 2) == 7.69 and d["median"]["severity"] == "INFO"
    assert drift.drift_gate(drift.numeric_drift(now, base)).first()["action"] == "pass"
    hot = drift.numeric_drift(now, base, DriftLimits(1.0, 7.0))
    assert drift.drift_gate(hot).first()["action"] == "abort"
    snaps = spark.createDataFrame([("1",), ("2",)], "snapshot_date string")
    assert rows(drift.gate_with_bootstrap(snaps, hot), "snapshot_date", "bootstrap", "action") == [
        ("1", True, "pass"), ("2", False, "abort")]
