"""Drift: profiles against baselines, record by record."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from snapgate.config import DriftLimits
from snapgate.functions.measures import pct_drift, severity
from snapgate.operators.baseline import BASELINE_METRICS
from snapgate.operators.profile import NUMERIC_METRICS
from snapgate.sources.metrics import latest_record

RECORD = ["snapshot_date", "column", "type", "metric", "baseline", "current", "drift_pct",
          "severity"]


def metric_rows(df: DataFrame, metrics: list[str], value: str, by: str = "snapshot_date") -> DataFrame:
    """``(by, column, metric, value)``, one row per statistic."""
    pairs = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias(value))
                      for m in metrics])
    return df.select(by, "column", F.inline(pairs))


def last_baseline(baselines: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Of repeated baseline records the last one counts."""
    return latest_record(baselines, [by, "column", "type"], ["run_seq"])


def numeric_drift(profile: DataFrame, baseline: DataFrame, limits: DriftLimits = DriftLimits(),
                  by: str = "snapshot_date", **drift_options) -> DataFrame:
    """One record per snapshot, column and statistic that has a baseline (``count`` has none)."""
    current = metric_rows(profile, NUMERIC_METRICS, "current", by)
    base = metric_rows(baseline, BASELINE_METRICS, "baseline", by)
    joined = current.join(base, [by, "column", "metric"])
    drift = joined.withColumn(
        "drift_pct", pct_drift(F.col("current"), F.col("baseline"), **drift_options))
    return drift.select(
        by, "column", F.lit("numeric").alias("type"), "metric", "baseline", "current", "drift_pct",
        severity(F.col("drift_pct"), limits.warn_at, limits.critical_at).alias("severity"))


def categorical_drift(profile: DataFrame, baseline: DataFrame, limits: DriftLimits = DriftLimits(),
                      by: str = "snapshot_date", **drift_options) -> DataFrame:
    """One ``cardinality`` record per snapshot and column that has a baseline."""
    joined = profile.select(by, "column", F.col("cardinality").cast("double").alias("current")).join(
        baseline.select(by, "column", F.col("avg_cardinality").alias("baseline")), [by, "column"])
    drift = joined.withColumn(
        "drift_pct", pct_drift(F.col("current"), F.col("baseline"), **drift_options))
    return drift.select(
        by, "column", F.lit("categorical").alias("type"), F.lit("cardinality").alias("metric"),
        "baseline", "current", "drift_pct",
        severity(F.col("drift_pct"), limits.warn_at, limits.critical_at).alias("severity"))


def drift_records(numeric: DataFrame, categorical: DataFrame) -> DataFrame:
    return numeric.unionByName(categorical)


def drift_gate(records: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Per snapshot the number of records by severity and whether the run must stop."""
    count = {s: F.count_if(F.col("severity") == s) for s in ("CRITICAL", "WARN", "INFO")}
    return records.groupBy(by).agg(
        *[c.alias(f"{s.lower()}_records") for s, c in count.items()],
        F.when(count["CRITICAL"] > 0, "abort").otherwise("pass").alias("action"))


def gate_with_bootstrap(snapshots: DataFrame, records: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """The gate for every snapshot; one without a baseline has no records and passes."""
    return (snapshots.select(by).distinct().join(drift_gate(records, by), by, "left")
            .select(by, F.col("action").isNull().alias("bootstrap"),
                    F.coalesce("critical_records", F.lit(0)).alias("critical_records"),
                    F.coalesce("action", F.lit("pass")).alias("action")))


#: Share that stands for a value without rows in the stability index, whose logarithm has none for 0.
LEAST_SHARE = 1e-4
#: Values named in a record; their number is always complete.
NAMED = 5


def counted_values(profiles: DataFrame, values: str = "top_5_values", by: str = "snapshot_date") -> DataFrame:
    """``(by, column, value, n)`` of profiles or baselines that hold their values as a map."""
    return profiles.select(by, "column", F.explode(values).alias("value", "n")).withColumn("n", F.col("n").cast("double"))


def distribution_drift(current: DataFrame, baseline: DataFrame, limits: DriftLimits = DriftLimits(0.1, 0.25),
                       by: str = "snapshot_date") -> DataFrame:
    """How far each column's values are from the baseline's, by their shares: one record per snapshot and column.

    Both sides are ``(by, column, value, n)`` with one row per value. ``js_distance`` is the root
    of the Jensen-Shannon divergence in bits, from 0 (equal) to 1 (no value in common); ``psi`` is
    the population stability index, which ``limits`` judge. ``new`` and ``vanished`` values are
    counted, and the most frequent of them named. A snapshot or column that only one side has is
    left out, as there is nothing to compare it with.
    """
    keys = [by, "column"]
    totals = [side.groupBy(*keys).agg(F.sum("n").cast("double").alias(name)) for side, name in ((current, "n_now"), (baseline, "n_base"))]
    known = totals[0].join(totals[1], keys).where("n_now > 0 and n_base > 0")
    sides = current.select(*keys, "value", F.col("n").alias("now")).join(
        baseline.select(*keys, "value", F.col("n").alias("base")), [*keys, "value"], "full_outer").join(known, keys)
    p, q = (F.coalesce(F.col(c), F.lit(0)) / F.col(f"n_{c}") for c in ("now", "base"))
    pq = sides.withColumns({"p": p, "q": q}).withColumn("m", (F.col("p") + F.col("q")) / 2).where("m > 0")
    part = lambda c: F.when(F.col(c) > 0, F.col(c) * F.log2(F.col(c) / F.col("m"))).otherwise(0.0)
    floor = lambda c: F.greatest(F.col(c), F.lit(LEAST_SHARE))
    stable = (floor("p") - floor("q")) * F.ln(floor("p") / floor("q"))
    kind = F.when(F.col("q") == 0, "new").when(F.col("p") == 0, "vanished")
    pq = pq.withColumn("kind", kind).withColumn("rank", F.when(F.col("kind").isNotNull(), F.row_number().over(
        Window.partitionBy(*keys, "kind").orderBy(F.col("m").desc(), "value"))))
    named = lambda k: F.transform(F.sort_array(F.collect_list(F.when(
        (F.col("kind") == k) & (F.col("rank") <= NAMED), F.struct("rank", "value")))), lambda x: x["value"])
    out = pq.groupBy(*keys).agg(
        F.sqrt(F.greatest((F.sum(part("p")) + F.sum(part("q"))) / 2, F.lit(0.0))).alias("js_distance"), F.sum(stable).alias("psi"),
        F.count_if(F.col("kind") == "new").alias("new_values"), F.count_if(F.col("kind") == "vanished").alias("vanished_values"),
        named("new").alias("new_named"), named("vanished").alias("vanished_named"))
    return out.withColumn("severity", severity(F.col("psi"), limits.warn_at, limits.critical_at))
