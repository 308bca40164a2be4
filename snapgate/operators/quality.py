"""Data quality: row-count change, null percentages, status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapgate.config import QualityLimits
from snapgate.functions.measures import pct_change, two_places
from snapgate.functions.text import is_missing
from snapgate.sources.metrics import latest_record


def snapshot_metrics(df: DataFrame, columns: Sequence[str], by: str = "snapshot_date") -> DataFrame:
    """Row count and per-column missing counts of each snapshot, in one aggregate."""
    present = [c for c in columns if c in df.columns]
    return df.groupBy(by).agg(
        F.count("*").alias("row_count"),
        *[F.count_if(is_missing(df, c)).alias(f"nulls_{c}") for c in present])


def null_percentages(metrics: DataFrame, columns: Sequence[str], by: str = "snapshot_date") -> DataFrame:
    """``(by, column, null_values, row_count, null_pct)`` from :func:`snapshot_metrics`."""
    present = [c for c in columns if f"nulls_{c}" in metrics.columns]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"nulls_{c}").alias("null_values"),
                              _null_pct(c).alias("null_pct")) for c in present])
    return metrics.select(by, "row_count", F.inline(rows))


def _null_pct(column: str) -> Column:
    """Unknown, hence passing, for an empty snapshot."""
    return F.when(F.col("row_count") > 0, F.col(f"nulls_{column}") * 100.0 / F.col("row_count"))


def row_count_change(metrics: DataFrame, by: str = "snapshot_date",
                     partition: Sequence[str] = ()) -> DataFrame:
    """Change against the snapshot before, over the per-snapshot counts (never the rows)."""
    keys = list(partition) or [F.lit(0)]
    previous = F.lag("row_count").over(Window.partitionBy(*keys).orderBy(by))
    return metrics.withColumn("previous_count", previous).withColumn(
        "row_count_change_pct", pct_change(F.col("row_count"), F.col("previous_count")))


def row_count_change_from_history(metrics: DataFrame, history: DataFrame,
                                  dataset: str = "dataset") -> DataFrame:
    """Change against the newest record of the metric history, whichever snapshot it is of.

    This is what a re-run compares with: its own earlier record. ``history`` has
    ``(dataset, snapshot_date, run_seq, row_count)``.
    """
    newest = latest_record(history, [dataset], ["snapshot_date", "run_seq"]).select(
        dataset, F.col("row_count").alias("previous_count"))
    return metrics.join(newest, dataset, "left").withColumn(
        "row_count_change_pct", pct_change(F.col("row_count"), F.col("previous_count")))


def quality_status(metrics: DataFrame, limits: QualityLimits,
                   rules: dict[str, Column] | None = None) -> DataFrame:
    """Add ``status`` and ``reasons`` to metrics that have ``row_count_change_pct``.

    Limits are strict. A null breach, a missing critical column, a previous count of zero or
    a failed extra rule is FAILED and outranks the row-count WARN. ``rules`` maps a name to a
    Boolean column over the metrics that must hold.
    """
    problems = []
    for c in limits.critical_columns:
        if f"nulls_{c}" in metrics.columns:
            problems.append(F.when(_null_pct(c) > limits.null_pct, F.lit(f"nulls:{c}")))
        else:
            problems.append(F.lit(f"missing:{c}"))
    problems.append(F.when(F.col("previous_count") == 0, F.lit("previous count is zero")))
    problems += [F.when(~rule, F.lit(f"rule:{name}")) for name, rule in (rules or {}).items()]
    failures = F.array_compact(F.array(*problems))
    changed = F.col("row_count_change_pct") > limits.row_count_change_pct
    warnings = F.array_compact(F.array(F.when(changed, F.lit("row count"))))
    status = (F.when(F.size("failures") > 0, "FAILED")
              .when(F.size("warnings") > 0, "WARN").otherwise("PASSED"))
    return (metrics.withColumns({"failures": failures, "warnings": warnings})
            .withColumn("status", status)
            .withColumn("reasons", F.concat("failures", "warnings")).drop("failures", "warnings"))


def quality_record(metrics: DataFrame, limits: QualityLimits,
                   rules: dict[str, Column] | None = None, by: str = "snapshot_date") -> DataFrame:
    """The metric record: counts, change and null percentages rounded to two places and as they are, status."""
    present = [c for c in limits.critical_columns if f"nulls_{c}" in metrics.columns]

    def nulls(of):
        pairs = [F.struct(F.lit(c), of(_null_pct(c))) for c in present]
        return F.map_from_entries(F.array(*pairs)) if pairs else F.create_map().cast("map<string,double>")
    change = F.col("row_count_change_pct")
    return quality_status(metrics, limits, rules).select(
        by, "row_count", nulls(two_places).alias("null_percentages"), "status",
        two_places(change).alias("row_count_change_pct"), "reasons",
        nulls(lambda c: c.cast("double")).alias("exact_null_percentages"), change.cast("double").alias("exact_row_count_change_pct"))


