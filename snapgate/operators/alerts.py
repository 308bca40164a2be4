"""Alerts as rows: every gate's findings in one shape."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Alert sources and messages.
SCHEMA_CHECK = "SCHEMA_CHECK"
DATA_QUALITY = "DATA_QUALITY"
DRIFT_DETECTOR = "DRIFT_DETECTOR"
GOLD_LOADER = "GOLD_LOADER"
SCHEMA_FAILED = "Schema enforcement failed"
BREAKING_CHANGE = "Breaking schema change detected"
VERSION_REGISTERED = "New schema version registered: "
ROW_COUNT_DRIFT = "Row count drift detected"
NULLS_EXCEEDED = "Null percentage threshold exceeded"
QUALITY_FAILED = "Data quality check failed"
NUMERIC_DRIFT = "Numeric drift detected: "
CATEGORICAL_DRIFT = "Categorical drift detected: "
GOLD_FAILED = "Gold load failed"
GOLD_LOADED = "Gold load completed successfully"
INGESTION = "INGESTION"
FILE_TOO_LATE = "File came too late for its snapshot and was not read"
RULE_BROKEN = "Rule broken: "
SILVER_EMPTY = "Silver dataset is empty — no rows loaded"
ALREADY_PROCESSED = "Snapshot already processed — skipping Gold load"

ALERT_COLUMNS = ["severity", "source", "snapshot_date", "message", "details", "timestamp"]


def alerts_from(df: DataFrame, severity: str | Column, source: str, message: str | Column,
                details: Sequence[str | Column], run_ts: str,
                snapshot: str | Column = "snapshot_date") -> DataFrame:
    """One alert per row of ``df``; ``details`` become a JSON text."""
    as_col = lambda x: F.lit(x) if isinstance(x, str) else x
    body = F.to_json(F.struct(*details)) if details else F.lit("{}")
    snap = F.col(snapshot) if isinstance(snapshot, str) else snapshot
    return df.select(
        as_col(severity).alias("severity"), F.lit(source).alias("source"),
        snap.cast("string").alias("snapshot_date"), as_col(message).alias("message"),
        body.alias("details"), F.lit(run_ts).alias("timestamp"))


def schema_alerts(scorecards: DataFrame, run_ts: str) -> DataFrame:
    return alerts_from(scorecards.where("status = 'FAILED'"), "CRITICAL", SCHEMA_CHECK, SCHEMA_FAILED,
                       ["checks_passed", "missing_columns", "uncastable_columns", "null_columns"], run_ts)


def contract_alerts(actions: DataFrame, changes: DataFrame, snapshot: str, run_ts: str) -> DataFrame:
    """The contract gate's alerts; ``issues`` has at most two entries per contract column."""
    issues = (changes.where("kind = 'breaking'").groupBy("dataset")
              .agg(F.array_sort(F.collect_list("change")).alias("issues")))
    at = F.lit(snapshot)
    breaking = alerts_from(actions.where("action = 'abort'").join(issues, "dataset"), "CRITICAL",
                           SCHEMA_CHECK, BREAKING_CHANGE, ["dataset", "issues"], run_ts, at)
    new = alerts_from(actions.where("action = 'register'"), "INFO", SCHEMA_CHECK,
                      F.concat(F.lit(VERSION_REGISTERED), "effective_version"), ["dataset"], run_ts, at)
    return breaking.unionByName(new)


def failure_alert(spark: SparkSession, source: str, message: str, snapshots: Sequence[str],
                  error: str, run_ts: str) -> DataFrame:
    """One CRITICAL alert per snapshot of a job that failed."""
    failed = spark.createDataFrame([(s, error) for s in snapshots], "snapshot_date string, error string")
    return alerts_from(failed, "CRITICAL", source, message, ["error"], run_ts)


def quality_alerts(statuses: DataFrame, run_ts: str) -> DataFrame:
    """One alert per finding of a snapshot: WARN for row count, CRITICAL for the rest.

    Given whole quality records, the details hold their percentages as well.
    """
    percentages = (["row_count_change_pct", "null_percentages"]
                   if "null_percentages" in statuses.columns else [])
    found = statuses.select("snapshot_date", "row_count", F.explode("reasons").alias("reason"), *percentages)
    is_warn = F.col("reason") == "row count"
    return alerts_from(
        found, F.when(is_warn, "WARN").otherwise("CRITICAL"), DATA_QUALITY,
        F.when(is_warn, F.lit(ROW_COUNT_DRIFT))
        .when(F.col("reason").startswith("nulls:"), NULLS_EXCEEDED)
        .otherwise(QUALITY_FAILED),
        ["row_count", "reason", *percentages], run_ts)


def rule_alerts(found: DataFrame, run_ts: str) -> DataFrame:
    """One CRITICAL alert per snapshot and row rule beyond its limit."""
    return alerts_from(found.where("status = 'FAILED'"), "CRITICAL", DATA_QUALITY, F.concat(F.lit(RULE_BROKEN), "rule"),
                       ["row_count", "violations", "violated_pct"], run_ts)


def drift_alerts(records: DataFrame, run_ts: str) -> DataFrame:
    found = records.where("severity <> 'INFO'")
    message = F.when(F.col("type") == "numeric",
                     F.concat(F.lit(NUMERIC_DRIFT), "column", F.lit(":"), "metric")
                     ).otherwise(F.concat(F.lit(CATEGORICAL_DRIFT), "column"))
    return alerts_from(found, F.col("severity"), DRIFT_DETECTOR, message,
                       ["baseline", "current", "drift_pct"], run_ts)


def gold_loaded(counts: DataFrame, version: str, run_ts: str) -> DataFrame:
    details = ["source_rows", "distinct_keys", "inserted", "updated", "schema_version"]
    return alerts_from(counts.withColumn("schema_version", F.lit(version)), "INFO", GOLD_LOADER,
                       GOLD_LOADED, details, run_ts)


def silver_empty(snapshots: DataFrame, run_ts: str) -> DataFrame:
    return alerts_from(snapshots, "WARN", GOLD_LOADER, SILVER_EMPTY, [], run_ts)


def late_files(files: DataFrame, run_ts: str) -> DataFrame:
    """One WARN alert per file that came after its snapshot's time was up."""
    return alerts_from(files, "WARN", INGESTION, FILE_TOO_LATE, ["path"], run_ts)


def already_processed(snapshots: DataFrame, run_ts: str) -> DataFrame:
    return alerts_from(snapshots, "INFO", GOLD_LOADER, ALREADY_PROCESSED, [], run_ts)


def union_alerts(alerts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, alerts).select(*ALERT_COLUMNS)
