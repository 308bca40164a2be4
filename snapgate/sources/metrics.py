"""Metric history: JSON lines per snapshot, read with fixed schemas."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from snapgate.sinks.publish import listed, put_if_absent, read_text, remove
from snapgate.sources.snapshots import path_exists, snapshot_paths

SNAPSHOT_KEY = "snapshot_date"
#: Marks a history some of whose snapshots were compacted.
COMPACTED = "_compacted"
#: What the files that name replaced files begin with.
REPLACED = "_replaced-"

_HEAD = "snapshot_date string, "
_TAIL = ", timestamp string, run_seq bigint"

# Field names and types of the metric records.
SCHEMA_METRIC = (_HEAD + "schema_version string, checks_passed int, checks_failed int, "
                         "status string" + _TAIL)
QUALITY_METRIC = (_HEAD + "format string, row_count bigint, null_percentages map<string,double>, "
                          "status string, row_count_change_pct double, "
                          "exact_null_percentages map<string,double>, exact_row_count_change_pct double" + _TAIL)
PROFILE_METRIC = (_HEAD + "layer string, column string, type string, metrics struct<count: bigint, "
                          "mean: double, median: double, std: double, min: double, max: double, "
                          "p25: double, p50: double, p75: double, cardinality: bigint, "
                          "top_5_values: map<string,bigint>, distinct_sketch: string, "
                          "buckets: array<struct<b: int, n: bigint, lo: double, hi: double>>>" + _TAIL)
BASELINE_METRIC = (_HEAD + "layer string, column string, type string, baseline struct<mean: double, "
                           "median: double, std: double, min: double, max: double, p25: double, "
                           "p50: double, p75: double, avg_cardinality: double, "
                           "top_values: map<string,double>, seen_values: array<string>, "
                           "pooled_mean: double, pooled_std: double, window_p25: double, window_p50: double, "
                           "window_p75: double, window_distinct: bigint>, history_snapshots bigint" + _TAIL)
DRIFT_METRIC = (_HEAD + "layer string, column string, metric string, baseline double, "
                        "current double, drift_pct double, severity string, exact_drift_pct double" + _TAIL)
DISTRIBUTION_METRIC = (_HEAD + "layer string, column string, js_distance double, psi double, new_values bigint, "
                               "vanished_values bigint, new_named array<string>, vanished_named array<string>, "
                               "severity string" + _TAIL)
RULE_METRIC = (_HEAD + "rule string, row_count bigint, violations bigint, violated_pct double, status string" + _TAIL)
CLEANING_METRIC = (_HEAD + "rows_in bigint, rows_after_nulls bigint, rows_after_dedup bigint, dropped_nulls bigint, "
                           "dropped_duplicates bigint, duplicated_keys bigint" + _TAIL)
ALERT = ("severity string, source string, snapshot_date string, message string, "
         "details string, timestamp string")


def read_metrics(spark: SparkSession, path: str, schema: str,
                 snapshots: Sequence[str] | None = None) -> DataFrame:
    """The metric history, whole or of the given snapshots; an absent path is an empty history."""
    paths = [p for p in snapshot_paths(path, snapshots) if path_exists(spark, p)]
    if paths and path_exists(spark, f"{path}/{COMPACTED}"):
        folders = [f"{path}/{n}" for n in listed(spark, path) if "=" in n] if snapshots is None else paths
        paths = [f"{folder}/{name}" for folder in folders for name in live_files(spark, folder)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).json(paths)


def live_files(spark: SparkSession, folder: str) -> list[str]:
    """The record files of a snapshot that count: those no finished compaction has replaced.

    Of compactions that ran at once and replaced a file both, the one of the lower number counts.
    """
    names = listed(spark, folder)
    gone = set()
    for name in names:                                       # in order of their numbers
        if name.startswith(REPLACED) and _compact_name(name) in names:
            replaced = json.loads(read_text(spark, f"{folder}/{name}"))
            gone.update([_compact_name(name)] if gone.intersection(replaced) else replaced)
    return [n for n in names if n.endswith(".json") and not n.startswith(("_", ".")) and n not in gone]


def _compact_name(replaced: str) -> str:
    return "compact-" + replaced.removeprefix(REPLACED)


def compact_metrics(spark: SparkSession, path: str, snapshots: Sequence[str] | None = None, limit: int = 32) -> int:
    """Put the records of snapshots with more than ``limit`` files in one file each; returns how many were.

    Records stay as they are, line by line, so ``run_seq`` still tells the newest. A compaction
    first names the files it replaces, in a file of its number that only one writer can create,
    and then puts its own file there whole: readers see the old files or the new one, never both.
    What it replaced stays for readers under way and goes with the next compaction, so a snapshot
    has at most about twice ``limit`` files. A snapshot's records, a few for each column and run,
    pass through the driver.
    """
    folders = [n for n in listed(spark, path) if "=" in n] if snapshots is None else [f"{SNAPSHOT_KEY}={s}" for s in snapshots]
    done = 0
    for folder in (f"{path}/{n}" for n in folders):
        live = live_files(spark, folder)
        if len(live) <= limit:
            continue
        names = listed(spark, folder)
        number = 1 + max((int(n[len(REPLACED):-5]) for n in names if n.startswith(REPLACED)), default=0)
        named = f"{REPLACED}{number:06d}.json"
        put_if_absent(spark, f"{path}/{COMPACTED}", "")
        if not put_if_absent(spark, f"{folder}/{named}", json.dumps(live)):
            continue                                          # another compaction is at it
        lines = spark.read.text([f"{folder}/{n}" for n in live]).where("value <> ''").collect()
        if any(n > named for n in listed(spark, folder) if n.startswith(REPLACED)):
            continue                                          # a later one has taken over
        put_if_absent(spark, f"{folder}/{_compact_name(named)}", "\n".join(r["value"] for r in lines))
        done += 1
        stale = [n for n in names if n.endswith(".json") and n not in live and not n.startswith(REPLACED)]
        for name in [*stale, *(n for n in names if n.startswith(REPLACED) and _compact_name(n) in stale)]:
            remove(spark, f"{folder}/{name}")
    return done


def shaped(df: DataFrame, shape, name: str) -> Column:
    """A struct of type ``shape``: the columns of ``df`` by field name, absent ones NULL."""
    return F.struct(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in shape.fields]).alias(name)


def latest_record(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last record per key: newest snapshot, then newest run."""
    last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return (df.withColumn("_rn", F.row_number().over(last)).where("_rn = 1").drop("_rn"))


def field_type(schema: str, name: str):
    from pyspark.sql.types import StructType
    return StructType.fromDDL(schema)[name].dataType
