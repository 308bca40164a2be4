"""Time the headline queries; prints one JSON line.

Every query is run to completion into the ``noop`` sink: once to warm up, then
``BENCH_RUNS`` times, of which the fastest counts. The ``job_`` entries are the jobs from raw CSV
to Gold over yearly snapshots of the line items. The total is the sum over all of them.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession, functions as F

from snapgate.config import PLAYER_STATS, DriftLimits, QualityLimits
from snapgate.plans import jobs
from snapgate.sinks.layers import write_layer
from snapgate.sinks.scratch import scratch_dir
from snapgate.suite import catalog
from snapgate.suite.inputs import table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "silver_clean", "silver_row_accounting", "dedup_keep_first_lineitem", "cast_rejects",
    "bronze_roundtrip", "silver_roundtrip", "raw_csv_scan_rows",
    "schema_scorecard", "schema_castability", "schema_diff", "schema_missing_columns",
    "dq_record", "dq_status",
    "profile_numeric", "profile_numeric_lineitem", "profile_numeric_narrowing",
    "profile_categorical", "value_counts",
    "baseline_rolling", "baseline_numeric", "baseline_categorical",
    "drift_numeric", "drift_categorical", "drift_records", "drift_gate",
    "gold_last_wins", "gold_upsert", "gold_upsert_stored", "alerts_union",
]


DAYS = [f"{year}-01-01" for year in range(1995, 2002)]
JOBS = ["ingest", "validate_and_clean", "enforce_schema", "check_quality", "run_profiling",
        "build_baseline", "detect_drift", "load_gold"]


def write_raw(spark, root):
    """Line items as yearly raw CSV snapshots of player statistics."""
    day = F.concat(F.year("l_shipdate").cast("string"), F.lit("-01-01"))
    rows = table(spark, SF_DIR, "lineitem").select(
        F.col("l_suppkey").alias("player_id"), F.concat(F.lit("P"), "l_suppkey").alias("player_name"),
        F.col("l_linestatus").alias("team"), F.col("l_returnflag").alias("season"),
        F.col("l_quantity").cast("int").alias("points"), F.col("l_linenumber").alias("assists"),
        F.round(F.col("l_discount") * 100).cast("int").alias("rebounds"),
        day.alias("snapshot_time_date"), day.alias("snapshot_date"))
    write_layer(rows, f"{root}/raw", "csv")


def time_jobs(spark):
    """Each job once over all snapshots, after a first run of the whole chain to warm up."""
    loose = DriftLimits(1e6, 1e9)
    cfg = replace(PLAYER_STATS, numeric_drift=loose, cardinality_drift=loose,
                  quality=QualityLimits(1e6, 5.0, PLAYER_STATS.quality.critical_columns))
    for _ in range(2):
        root, times = scratch_dir(spark), {}
        write_raw(spark, root)
        run = jobs.Run(root, "2024-02-01 00:00:00", 1)
        for name in JOBS:
            start = time.perf_counter()
            getattr(jobs, name)(spark, cfg, run, DAYS)
            times[f"job_{name}"] = round(time.perf_counter() - start, 3)
    return times


def main():
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "16g")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    queries, times = catalog.queries(), {}
    for name in names:
        best = None
        for i in range(RUNS + 1):
            start = time.perf_counter()
            queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            if i and (best is None or took < best):
                best = took
        times[name] = round(best, 3)
    if names == HEADLINE:
        times.update(time_jobs(spark))
    print(json.dumps({"metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
