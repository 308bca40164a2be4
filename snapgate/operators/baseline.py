"""Baselines over the profiles of the last N snapshots.

Profiles are metadata: one row per snapshot and column. They are small however large the
snapshots are, so windows over them are safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

BASELINE_METRICS = ["mean", "median", "std", "min", "max", "p25", "p50", "p75"]
_FOLD = {"mean": F.avg, "median": F.median, "std": F.avg, "min": F.min, "max": F.max,
         "p25": F.avg, "p50": F.avg, "p75": F.avg}


def window_members(snapshots: DataFrame, window: int = 7, by: str = "snapshot_date") -> DataFrame:
    """``(snapshot_date, member)``: the up to ``window`` snapshots before each snapshot.

    Each snapshot names the ranks it serves, so the pairs come from an equality join. A
    snapshot without a profile is listed too and so uses up a place.
    """
    ranked = snapshots.select(by).distinct().withColumn(
        "_r", F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy(by)))
    serves = ranked.select(F.col(by).alias("member"),
                           F.explode(F.sequence(F.col("_r") + 1, F.col("_r") + window)).alias("_r"))
    return ranked.join(serves, "_r").select(by, "member")


def previous_snapshots(snapshots: DataFrame, current: str, window: int = 7,
                       by: str = "snapshot_date") -> DataFrame:
    """The newest ``window`` snapshots strictly before ``current``."""
    return (snapshots.select(by).distinct().where(F.col(by) < current)
            .orderBy(F.col(by).desc()).limit(window))


def history_of(profile: DataFrame, members: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Profile records repeated for every snapshot whose window they are in."""
    return members.join(profile.withColumnRenamed(by, "member"), "member").drop("member")


def numeric_baseline(history: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Fold the history per column: mean of means, median of medians, extremes of extremes."""
    return history.groupBy(by, "column").agg(
        *[_FOLD[m](m).alias(m) for m in BASELINE_METRICS],
        F.count("*").alias("history_snapshots"))


def categorical_values(history: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Per value the mean of its counts over only the records that had it in their top values."""
    return (history.select(by, "column", F.explode("top_5_values").alias("value", "n"))
            .groupBy(by, "column", "value")
            .agg(F.avg("n").alias("avg_count"), F.count("*").alias("seen_in")))


def categorical_baseline(history: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Mean cardinality, mean counts of the top values, and every top value seen.

    The collected lists hold at most k values for each record of the window.
    """
    base = history.groupBy(by, "column").agg(
        F.avg("cardinality").alias("avg_cardinality"),
        F.count("*").alias("history_snapshots"))
    pairs = F.sort_array(F.collect_list(F.struct("value", "avg_count")))
    values = categorical_values(history, by).groupBy(by, "column").agg(
        F.map_from_entries(pairs).alias("top_values"))
    empty = F.create_map().cast("map<string,double>")
    top = F.coalesce("top_values", empty)
    return (base.join(values, [by, "column"], "left")
            .select(by, "column", "avg_cardinality", top.alias("top_values"),
                    F.array_sort(F.map_keys(top)).alias("seen_values"), "history_snapshots"))


def rolling_baseline(profile: DataFrame, window: int = 7, by: str = "snapshot_date") -> DataFrame:
    """:func:`numeric_baseline` for every snapshot in one window pass, without a join.

    Needs exactly one profile record per snapshot and column; with re-runs use
    :func:`window_members` and :func:`history_of`.
    """
    w = Window.partitionBy("column").orderBy(by).rowsBetween(-window, -1)
    folds = {**_FOLD, "median": lambda c: F.percentile(c, 0.5)}
    return (profile.select(by, "column", *[folds[m](m).over(w).alias(m) for m in BASELINE_METRICS],
                           F.count("*").over(w).alias("history_snapshots"))
            .where("history_snapshots > 0"))
