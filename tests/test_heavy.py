"""Top values in bounded memory equal those of all value counts."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapgate.operators import heavy, profile as pf


def test_a_summary_counts_too_low_by_no_more_than_it_says():
    rng = np.random.default_rng(4)
    for _ in range(50):
        size = rng.integers(1, 60, 4)
        group = rng.permutation(np.repeat(np.arange(4), size))
        counts, m = rng.integers(1, 40, len(group)), int(rng.integers(1, 30))
        stay, left, taken = heavy.trimmed(group, counts, m)
        assert (np.bincount(group[stay], minlength=4) <= m).all() and ((taken > 0) == (size > m)).all()
        lowered = np.zeros(len(group), np.int64)
        lowered[stay] = left
        assert (left > 0).all() and (lowered == np.maximum(counts - taken[group], 0)).all()


def rows_of(df):
    return sorted(map(tuple, df.select("day", "column", "value", "n", "rank").collect()), key=repr)


@pytest.fixture
def small_hold(monkeypatch):
    monkeypatch.setattr(heavy, "HELD", 0.01)   # a summary after each batch


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(8)
    rows = []
    for i in range(30_000):
        skew = rng.randrange(8) if rng.random() < 0.4 else 100 + rng.randrange(40_000)
        rows.append((["a", "b", None][i % 3], f"z{skew}", i if i % 4 else 7, None if i % 5 else float("nan"), rng.choice("xy")))
    return spark.createDataFrame(rows, "day string, zipf string, nearly_unique int, nothing double, few string").repartition(6)


@pytest.mark.parametrize("counters, rounds", [(64, 1), (64, 2), (4, 2), (5000, 1)])
def test_bounded_top_values_are_exact(skewed, small_hold, counters, rounds):
    columns = ["zipf", "nearly_unique", "nothing", "few", "absent"]
    got = heavy.top_values_bounded(skewed, columns, 5, "day", counters, rounds)
    expected = pf.top_values(pf.value_counts(skewed, columns[:4], "day"), 5, "day")
    assert rows_of(got) == rows_of(expected)


def test_a_heavy_column_is_proven_without_counting_all_its_values(spark, skewed, monkeypatch):
    """A hundred times more values than counters: one round, and few values are counted."""
    left = []
    counted = heavy._counted
    monkeypatch.setattr(heavy, "_counted", lambda df, columns, by, wanted, on: left.append((wanted.count(), list(on))) or counted(df, columns, by, wanted, on))
    heavy.top_values_bounded(skewed, ["zipf"], 5, "day", 64).collect()
    assert skewed.select("zipf").distinct().count() > 100 * 64
    assert len(left) == 1 and left[0][1] == ["by", "column", "value"] and left[0][0] < 3 * 200


def test_counting_all_values_is_dealt_over_as_many_tasks_as_they_need(spark, monkeypatch):
    """However well the counts compress in a shuffle, a task counts about ``COUNTED`` values."""
    monkeypatch.setattr(heavy, "COUNTED", 1000, raising=False)
    monkeypatch.setattr(heavy, "PASSED", 500, raising=False)
    n = 40_000
    df = spark.range(n).selectExpr("concat('d', id % 2) as day", "id as unique", "if(id % 2 = 0, null, id % 7) as few")
    wanted = spark.createDataFrame([("=d0", "unique"), ("=d1", "unique"), ("=d1", "few")], "by string, column string")
    counted = heavy._counted(df, ["unique", "few"], "day", wanted, ["by", "column"])
    of_task = [r["count"] for r in counted.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(of_task) == n + 7 and max(of_task) < 2000
    assert sorted(r["n"] for r in counted.where("column = 'few'").collect()) == [2857] * 6 + [2858]
    assert {r["n"] for r in counted.where("column = 'unique'").collect()} == {1}
    narrow = heavy._counted(df, ["unique", "few"], "day", wanted.where("by = '=d0'"), ["by", "column"])
    assert narrow.count() == n // 2


def test_empty_and_null_tables(spark):
    empty = spark.createDataFrame([], "day date, g string")
    assert heavy.top_values_bounded(empty, ["g"], 5, "day").collect() == []
    assert heavy.top_values_bounded(empty, ["absent"], 5, "day").collect() == []
    nulls = spark.createDataFrame([(None, None), (None, "x")], "day date, g string")
    assert [tuple(r) for r in heavy.top_values_bounded(nulls, ["g"], 5, "day").collect()] == [(None, "g", "x", 1, 1)]
