"""Narrowing rounds find exact quantiles with one lookup a value."""

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from snapgate.operators.quantiles import select_quantiles
from snapgate.suite import drift_queries


@pytest.fixture(scope="module")
def prices(spark):
    rng = random.Random(5)
    rows = [("ab"[i % 3 == 0], rng.choice([rng.uniform(-90, 90), rng.gauss(0, 1e-3), 10.0 ** rng.randint(0, 9), 0.0, 7.5])) for i in range(6000)]
    return spark.createDataFrame(rows + [("a", None), ("b", float("nan"))], "g string, x double").repartition(3)


@pytest.mark.parametrize("sort_rows", [1, 20, 100_000])
def test_quantiles_are_exact_whatever_the_rounds(prices, sort_rows):
    probs = [i / 40 for i in range(41)]
    found = {(r["g"], r["prob"]): r["value"] for r in select_quantiles(prices, ["g"], ["x"], probs, sort_rows).collect()}
    rows = prices.where("x is not null and not isnan(x)").collect()
    expected = {(g, p): float(np.quantile([r["x"] for r in rows if r["g"] == g], p)) for g in "ab" for p in probs}
    assert found == pytest.approx(expected, rel=1e-12)


def test_a_value_is_compared_with_no_more_ranges_for_more_probabilities(prices):
    """Looking a value up costs the same for 4 and 101 probabilities: an equality join, no chain of conditions."""
    def plan(n):
        return select_quantiles(prices, ["g"], ["x"], [i / n for i in range(n + 1)])._jdf.queryExecution().optimizedPlan().toString()
    few, many = plan(3), plan(100)
    assert few.count("CASE WHEN") == many.count("CASE WHEN") and many.count(">=") == few.count(">=")


@pytest.mark.parametrize("sort_rows", [1, 50, 100_000])
def test_quantiles_of_groups_that_share_members(spark, prices, sort_rows):
    """Groups of one, two and no known member; a member is in two groups."""
    days = prices.unionByName(spark.createDataFrame([("c", None), ("d", 4.0), (None, 9.0)], "g string, x double"))
    groups = {"u": "ab", "v": "b", "w": "cd", "x": "c", "y": "z", None: "ad"}
    members = spark.createDataFrame([(g, m) for g, ms in groups.items() for m in ms], "g string, member string")
    probs = [0.0, 0.1, 0.25, 0.5, 0.93, 1.0]
    found = {(r["g"], r["prob"]): r["value"] for r in select_quantiles(days, ["g"], ["x"], probs, sort_rows, members=members).collect() if r["g"]}
    rows = days.where("x is not null and not isnan(x)").collect()
    expected = {(g, p): float(np.quantile(v, p)) for g, ms in groups.items() if g and (v := [r["x"] for r in rows if r["g"] and r["g"] in ms]) for p in probs}
    assert {g for g, _ in expected} == {"u", "v", "w"} and found == pytest.approx(expected, rel=1e-12)


def test_window_quantiles_store_no_rows_of_the_windows(spark, tmp_path, monkeypatch):
    """A snapshot's rows are not repeated for each of the seven windows it is in: only counts and targets are stored."""
    stored = []
    store = drift_queries.cut_lineage
    monkeypatch.setattr(drift_queries, "cut_lineage", lambda df: stored.append(store(df)) or stored[-1])
    n = 6000
    spark.range(n).select(F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, cast(id % 12 as int))").alias("ts"),
                          F.lit(1).cast("bigint").alias("user_id"), F.lit("e").alias("event_type"),
                          (F.col("id") * 7919 % 6007 / 10).alias("value"), F.lit("").alias("props")).write.parquet(f"{tmp_path}/events.parquet")
    found = drift_queries.window_quantiles(spark, str(tmp_path)).collect()
    assert len(found) == 11 * 2 * 3 and all(r["within"] for r in found)
    assert stored and sum(df.count() for df in stored) < n / 10
