"""The pipeline's jobs. Each takes its paths and snapshots explicitly and may be repeated.

A gate writes its metrics and alerts first and raises :class:`GateFailed` afterwards.
``snapshots`` is a list of ``YYYY-MM-DD`` texts; a back-fill passes many and runs as one job.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapgate.config import DatasetConfig
from snapgate.functions.measures import two_places
from snapgate.operators import (alerts as al, baseline as bl, cleaning, contracts, drift, gold,
                                mergeable as mg, profile as pf, rules as rl, quality as dq, schema_gate as sg)
from snapgate.sinks import publish as pub
from snapgate.sinks.layers import (append_metrics, read_registry, read_table, register_versions, write_empty,
                                   write_layer)
from snapgate.sinks.scratch import cut_lineage
from snapgate.sources import metrics as mt
from snapgate.sources.raw import ORDER_COLUMNS, SNAPSHOT, read_layer, read_raw, stamp
from snapgate.sources.snapshots import (cover, latest_snapshot, list_snapshots, require_snapshots)

log = logging.getLogger("snapgate")

PROCESSED_SCHEMA = "snapshot_date string, processed_at timestamp_ntz"

#: How often a Gold load merges again because another load was published first.
LOAD_ATTEMPTS = 5


class GateFailed(RuntimeError):
    """A gate refused the snapshot; its metrics and alerts are stored."""


@dataclass(frozen=True)
class Run:
    """One run: where the data lives, its time stamp and its sequence number."""

    root: str
    run_ts: str
    run_seq: int

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @classmethod
    def start(cls, spark: SparkSession, root: str, run_ts: str) -> Run:
        """A run with the next sequence number, which no other run of this root has."""
        folder = f"{root.rstrip('/')}/_runs"
        taken = [int(n.removesuffix(".json")) for n in pub.listed(spark, folder) if n.endswith(".json")]
        number = max(taken, default=0) + 1
        while not pub.put_if_absent(spark, f"{folder}/{number:012d}.json", json.dumps({"run_ts": run_ts})):
            number += 1
        return cls(root, run_ts, number)


def _only(df: DataFrame, snapshots: Sequence[str]) -> DataFrame:
    return df.where(F.col(SNAPSHOT).isin(list(snapshots)))


def _layer(spark: SparkSession, run: Run, name: str, cfg: DatasetConfig,
           snapshots: Sequence[str]) -> DataFrame:
    """The given snapshots of a layer; fails when one has no files."""
    require_snapshots(spark, run.path(name), snapshots, name)
    rows = read_layer(spark, run.path(name), cfg.layer_format, snapshots, cfg.raw_multi_line)
    if cfg.layer_format == "csv":
        types = {"_src_block": "bigint", "_src_pos": "bigint", "ingested_at": "timestamp_ntz"}
        rows = rows.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in rows.columns})
    return rows


def _wanted(spark: SparkSession, snapshots: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(s,) for s in snapshots], f"{SNAPSHOT} string")


def _emit(alerts: DataFrame, run: Run) -> None:
    alerts.write.mode("append").json(run.path("alerts"))


def _stop_on(bad: DataFrame, message: str, alerts: DataFrame, run: Run) -> None:
    """Emit the alerts and raise when there are refused snapshots."""
    rows = [r[0] for r in bad.select(SNAPSHOT).distinct().orderBy(SNAPSHOT).collect()]
    if rows:
        _emit(alerts, run)
        raise GateFailed(f"{message}: {rows}")


def ingest(spark: SparkSession, cfg: DatasetConfig, run: Run,
           snapshots: Sequence[str] | None = None) -> list[str]:
    """Raw to Bronze; without ``snapshots`` the newest raw one."""
    if not snapshots:
        newest = latest_snapshot(list_snapshots(spark, run.path("raw")))
        if newest is None:
            raise RuntimeError("no snapshots available for ingestion")
        snapshots = [newest]
    require_snapshots(spark, run.path("raw"), snapshots, "raw")
    raw = stamp(read_raw(spark, run.path("raw"), cfg.raw_format, snapshots, cfg.raw_multi_line), run.run_ts)
    write_layer(raw, run.path("bronze"), cfg.layer_format)
    _empty_others(raw, run.path("bronze"), cfg.layer_format, snapshots, _snapshots_of(raw))
    return list(snapshots)


def _snapshots_of(df: DataFrame) -> set[str]:
    """The snapshots with rows; partition values only, so no cell is read."""
    return {r[0] for r in df.select(F.col(SNAPSHOT).cast("string")).distinct().collect()}


def _empty_others(rows: DataFrame, path: str, file_format: str, snapshots: Sequence[str], full: set[str]) -> list[str]:
    """Empty the partitions of the snapshots without rows, whatever an earlier run left there."""
    empty = [s for s in snapshots if s not in full]
    write_empty(rows, path, empty, file_format)
    return empty


def validate_and_clean(spark: SparkSession, cfg: DatasetConfig, run: Run,
                       snapshots: Sequence[str], on_bad_cast: str = "fail") -> list[str]:
    """Bronze to Silver; with ``on_bad_cast='drop'`` refused rows go to ``rejects``.

    Stores the row accounting and duplicate report of each snapshot under ``metrics/cleaning``. Returns the
    snapshots that lost all their rows; each becomes an empty partition.
    """
    rows = _layer(spark, run, "bronze", cfg, snapshots)
    silver = cleaning.clean(rows, cfg.contract, [SNAPSHOT, *cfg.dedup_keys], ORDER_COLUMNS, on_bad_cast)
    write_layer(silver, run.path("silver"), cfg.layer_format, rebalance=True)
    taken = cleaning.drop_rejects(rows, cfg.contract) if on_bad_cast == "drop" else rows
    measured = cleaning.row_accounting(taken, cfg.contract.critical, [SNAPSHOT, *cfg.dedup_keys], duplicates=True)
    counted = cut_lineage(cover(_wanted(spark, snapshots), measured, [c for c in measured.columns if c != SNAPSHOT]))
    append_metrics(counted, run.path("metrics", "cleaning"), run.run_seq, run.run_ts)
    full = _snapshots_of(counted.where("rows_after_dedup > 0"))
    if on_bad_cast == "drop":
        rejects = cut_lineage(cleaning.cast_rejects(rows, cfg.contract))
        write_layer(rejects, run.path("rejects"))
        _empty_others(rejects, run.path("rejects"), "parquet", snapshots, _snapshots_of(rejects))
    return _empty_others(silver, run.path("silver"), cfg.layer_format, snapshots, full)


def registered_contract(spark: SparkSession, cfg: DatasetConfig, run: Run) -> DataFrame:
    """The registry rows of the data set; before the first registration its own contract."""
    rows = read_registry(spark, run.path("registry")).where(F.col("dataset") == cfg.dataset)
    if rows.isEmpty():
        return contracts.contract_rows(spark, cfg.dataset, [cfg.contract])
    return contracts.latest_contract(rows)


def enforce_schema(spark: SparkSession, cfg: DatasetConfig, run: Run, snapshots: Sequence[str],
                   register_first: bool = False) -> str:
    """Contract gate, then the data gate; returns the version in force.

    A new version is registered once the data has passed (``register_first`` registers it
    before the data is looked at). Where another run has registered that version with another
    contract, this one fails with :class:`publish.TakenError` and finds the other's contract when
    it is repeated.
    """
    incoming = contracts.contract_rows(spark, cfg.dataset, [cfg.contract])
    registered = registered_contract(spark, cfg, run)
    actions = contracts.gate_actions(registered, incoming)
    decision = actions.first()
    contract = replace(cfg.contract, version=decision["effective_version"])
    if decision["action"] != "pass":
        changes = contracts.diff_contracts(registered, incoming)
        _emit(al.contract_alerts(actions, changes, max(snapshots), run.run_ts), run)
    evolution_ok = decision["action"] != "abort"
    metrics = run.path("metrics", "schema")

    def register():
        if decision["action"] == "register":
            try:
                register_versions(contracts.rows_to_register(registered, incoming), run.path("registry"))
            except pub.TakenError as e:
                _emit(al.failure_alert(spark, al.SCHEMA_CHECK, al.SCHEMA_FAILED, snapshots, str(e), run.run_ts), run)
                raise

    if register_first:
        register()
    try:
        silver = _layer(spark, run, "silver", cfg, snapshots)
    except FileNotFoundError as e:
        failed = _wanted(spark, snapshots).select(
            SNAPSHOT, F.lit(contract.version).alias("schema_version"),
            F.lit(int(evolution_ok)).alias("checks_passed"), F.lit(1).alias("checks_failed"),
            F.lit("FAILED").alias("status"))
        append_metrics(failed, metrics, run.run_seq, run.run_ts)
        _emit(al.failure_alert(spark, al.SCHEMA_CHECK, al.SCHEMA_FAILED, snapshots, str(e), run.run_ts), run)
        raise
    cards = cut_lineage(sg.scorecard(silver, contract, evolution_ok=evolution_ok,
                                     snapshots=_wanted(spark, snapshots),
                                     strict_types=cfg.layer_format == "parquet"))
    extra = [c for c in silver.columns if c not in contract.names]
    log.info("columns beyond the contract (allowed): %s", extra)
    append_metrics(cards.select(SNAPSHOT, "schema_version", "checks_passed", "checks_failed", "status"),
                   metrics, run.run_seq, run.run_ts)
    _stop_on(cards.where("status = 'FAILED'"), "schema enforcement failed",
             al.schema_alerts(cards, run.run_ts), run)
    if not register_first:
        register()
    return contract.version


def check_quality(spark: SparkSession, cfg: DatasetConfig, run: Run, snapshots: Sequence[str],
                  compare_with: str = "previous_snapshot", rules: dict | None = None,
                  row_rules: Sequence[rl.Rule] = ()) -> None:
    """Quality metrics and gate.

    ``rules`` are conditions over the metrics, ``row_rules`` over the rows themselves: their
    counts are stored under ``metrics/rules``, the rows that break one under ``violations``, and
    a rule beyond its limit fails the gate.

    ``compare_with`` is ``previous_snapshot`` (strictly earlier, from this call's snapshots
    or the newest record of the history) or ``latest_record`` (the last record written,
    whatever its snapshot).
    """
    silver = _layer(spark, run, "silver", cfg, snapshots)
    path = run.path("metrics", "quality")
    measured = dq.snapshot_metrics(silver, cfg.quality.critical_columns)
    zeros = [c for c in measured.columns if c != SNAPSHOT]
    now = cover(_wanted(spark, snapshots), measured, zeros)
    if compare_with == "latest_record":
        dataset = F.lit(cfg.dataset).alias("dataset")
        past = mt.read_metrics(spark, path, mt.QUALITY_METRIC).select(dataset, SNAPSHOT, "run_seq", "row_count")
        compared = dq.row_count_change_from_history(now.withColumn("dataset", dataset), past).drop("dataset")
    else:
        before = _members(_recorded(spark, path), snapshots, 1) - set(snapshots)
        history = mt.read_metrics(spark, path, mt.QUALITY_METRIC, sorted(before))
        past = mt.latest_record(history, [SNAPSHOT], ["run_seq"]).select(SNAPSHOT, "row_count")
        compared = _only(dq.row_count_change(now.unionByName(past, allowMissingColumns=True)), snapshots)
    judged = cut_lineage(dq.quality_record(compared, cfg.quality, rules))
    append_metrics(judged.drop("reasons").withColumn("format", F.lit(cfg.layer_format)), path,
                   run.run_seq, run.run_ts)
    alerts, failed = al.quality_alerts(judged, run.run_ts), judged.where("status = 'FAILED'").select(SNAPSHOT)
    if row_rules:
        found = _check_row_rules(silver, run, snapshots, row_rules)
        alerts = al.union_alerts([alerts, al.rule_alerts(found, run.run_ts)])
        failed = failed.unionByName(found.where("status = 'FAILED'").select(SNAPSHOT))
    _stop_on(failed, "data quality checks failed", alerts, run)
    if not judged.where("status = 'WARN'").isEmpty():
        _emit(alerts, run)


def _check_row_rules(silver: DataFrame, run: Run, snapshots: Sequence[str], rules: Sequence[rl.Rule]) -> DataFrame:
    """Verdicts on the row rules, stored; the rows that break one are set aside."""
    counts = cut_lineage(rl.key_counts(silver, rules))
    broken = cut_lineage(rl.broken_keys(counts, rules))
    found = cut_lineage(rl.judge(counts, broken, rules))
    append_metrics(found, run.path("metrics", "rules"), run.run_seq, run.run_ts)
    aside = cut_lineage(rl.violating_rows(silver, rules, broken))
    write_layer(aside, run.path("violations"))
    _empty_others(aside, run.path("violations"), "parquet", snapshots, _snapshots_of(aside))
    return found


def _recorded(spark: SparkSession, path: str) -> list[str]:
    """The snapshots that have records, from the folder listing."""
    return [r[0] for r in list_snapshots(spark, path).collect()]


def _members(recorded: Sequence[str], snapshots: Sequence[str], window: int) -> set[str]:
    """Snapshots of which the records before each of ``snapshots`` are read: up to ``window`` each."""
    known = sorted({*recorded, *snapshots})
    return {m for s in snapshots for m in known[max(0, known.index(s) - window):known.index(s)]}


def run_profiling(spark: SparkSession, cfg: DatasetConfig, run: Run, snapshots: Sequence[str]) -> None:
    """Profiles of the snapshots; with ``cfg.mergeable_profiles`` each record also holds its mergeable state."""
    rows = _layer(spark, run, "silver", cfg, snapshots)
    absent = [c for c in (*cfg.numeric_columns, *cfg.categorical_columns) if c not in rows.columns]
    if absent:
        log.warning("columns missing in silver are not profiled: %s", absent)
    wanted = _wanted(spark, snapshots)
    shape = mt.field_type(mt.PROFILE_METRIC, "metrics")
    records = []
    for kind, profile, columns in (("numeric", _numeric_records, cfg.numeric_columns),
                                   ("categorical", _categorical_records, cfg.categorical_columns)):
        columns = [c for c in columns if c in rows.columns]
        if columns:
            full = pf.cover_profiles(wanted, profile(rows, columns, cfg.mergeable_profiles), columns)
            records.append(full.select(SNAPSHOT, F.lit("silver").alias("layer"), "column", F.lit(kind).alias("type"),
                                       mt.shaped(full, shape, "metrics")))
    if records:
        append_metrics(reduce(DataFrame.unionByName, records), run.path("metrics", "profile"), run.run_seq, run.run_ts)


def _numeric_records(rows: DataFrame, columns: Sequence[str], state: bool) -> DataFrame:
    data, buckets = pf.numeric_buckets(rows, columns)
    profile = pf.numeric_profile(data, buckets, columns)
    return profile.join(mg.as_buckets(buckets), [SNAPSHOT, "column"], "left") if state else profile


def _categorical_records(rows: DataFrame, columns: Sequence[str], state: bool) -> DataFrame:
    profile = pf.profile_categorical(rows, columns)
    return profile.join(mg.distinct_sketches(rows, columns), [SNAPSHOT, "column"], "left") if state else profile


def _profiles(spark: SparkSession, run: Run, snapshots: Sequence[str], all_records: bool = False) -> DataFrame:
    records = mt.read_metrics(spark, run.path("metrics", "profile"), mt.PROFILE_METRIC, snapshots)
    if not all_records:
        records = mt.latest_record(records, [SNAPSHOT, "column", "type"], ["run_seq"])
    return records.select(SNAPSHOT, "column", "type", "metrics.*")


def build_baseline(spark: SparkSession, cfg: DatasetConfig, run: Run, snapshots: Sequence[str],
                   all_records: bool = False) -> None:
    """Baselines from the profiles of earlier snapshots; without any, nothing is written."""
    recorded = _recorded(spark, run.path("metrics", "profile"))
    read = sorted(_members(recorded, snapshots, cfg.baseline_window))
    profiles = _profiles(spark, run, read, all_records)
    members = bl.window_members(_wanted(spark, sorted({*read, *snapshots})), cfg.baseline_window)
    history = bl.history_of(profiles, _only(members, snapshots))
    numeric = bl.numeric_baseline(history.where("type = 'numeric'"))
    categorical = bl.categorical_baseline(history.where("type = 'categorical'"))
    numeric, categorical = _with_windows(numeric, categorical, bl.history_of(_profiles(spark, run, read), _only(members, snapshots)),
                                         cfg.mergeable_profiles)
    shape = mt.field_type(mt.BASELINE_METRIC, "baseline")
    records = [kept.select(SNAPSHOT, F.lit("silver").alias("layer"), "column", F.lit(kind).alias("type"),
                           mt.shaped(kept, shape, "baseline"), "history_snapshots")
               for kind, kept in (("numeric", numeric), ("categorical", categorical))]
    append_metrics(records[0].unionByName(records[1]), run.path("metrics", "baseline"), run.run_seq, run.run_ts)


def _with_windows(numeric: DataFrame, categorical: DataFrame, history: DataFrame, state: bool) -> tuple[DataFrame, DataFrame]:
    """The baselines with the statistics of all rows of the window: moments always, the rest where profiles hold its state."""
    keys = [SNAPSHOT, "column"]
    numbers = history.where("type = 'numeric'")
    numeric = numeric.join(mg.pooled_moments(numbers).drop("rows"), keys, "left")
    if state:
        found = mg.window_quantiles(numbers.where("buckets is not null"), list(pf.QUANTILES.values()))
        numeric = numeric.join(found.groupBy(*keys).agg(*[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(f"window_{name}") for name, p in pf.QUANTILES.items()]), keys, "left")
        sketches = history.where("type = 'categorical' and distinct_sketch is not null")
        categorical = categorical.join(mg.window_distinct(sketches).withColumnRenamed("distinct_values", "window_distinct"), keys, "left")
    return numeric, categorical


def detect_drift(spark: SparkSession, cfg: DatasetConfig, run: Run, snapshots: Sequence[str],
                 all_records: bool = False, **drift_options) -> None:
    """Drift records and gate; snapshots without a baseline pass.

    How far the top values' shares lie from the baseline's is recorded beside it and gates nothing.
    """
    profiles = _profiles(spark, run, snapshots, all_records)
    if profiles.isEmpty():
        raise FileNotFoundError("profiling metrics missing")
    baselines = drift.last_baseline(
        mt.read_metrics(spark, run.path("metrics", "baseline"), mt.BASELINE_METRIC, snapshots)
    ).select(SNAPSHOT, "column", "type", "baseline.*")
    records = cut_lineage(drift.drift_records(
        drift.numeric_drift(profiles.where("type = 'numeric'"),
                            baselines.where("type = 'numeric'"), cfg.numeric_drift, **drift_options),
        drift.categorical_drift(profiles.where("type = 'categorical'"),
                                baselines.where("type = 'categorical'"), cfg.cardinality_drift,
                                **drift_options)))
    append_metrics(records.select(SNAPSHOT, F.lit("silver").alias("layer"), "column", "metric",
                                  "baseline", "current", two_places(F.col("drift_pct")).alias("drift_pct"),
                                  "severity", F.col("drift_pct").alias("exact_drift_pct")),
                   run.path("metrics", "drift"), run.run_seq, run.run_ts)
    apart = drift.distribution_drift(drift.counted_values(profiles.where("type = 'categorical'")),
                                     drift.counted_values(baselines.where("type = 'categorical'"), "top_values"))
    append_metrics(apart.select(SNAPSHOT, F.lit("silver").alias("layer"), *[c for c in apart.columns if c != SNAPSHOT]),
                   run.path("metrics", "distribution"), run.run_seq, run.run_ts)
    alerts = al.drift_alerts(records, run.run_ts)
    _stop_on(records.where("severity = 'CRITICAL'"), "CRITICAL drift detected", alerts, run)
    if not records.where("severity = 'WARN'").isEmpty():
        _emit(alerts, run)


def load_gold(spark: SparkSession, cfg: DatasetConfig, run: Run, snapshots: Sequence[str],
              version: str | None = None, force: bool = False) -> None:
    """Merge pending snapshots into Gold and mark them in the ledger, as one.

    The new state is published by one file (:mod:`snapgate.sinks.publish`): a run that dies
    before it has changed nothing, one that dies after it is complete. A run that another one
    overtakes merges again. ``force`` applies snapshots the ledger already lists, for corrections.
    """
    try:
        for left in reversed(range(LOAD_ATTEMPTS)):
            try:
                return _load_gold(spark, cfg, run, snapshots, version, force)
            except pub.TakenError as e:
                if not left:
                    raise
                log.warning("%s; merging again", e)
    except Exception as e:
        _emit(al.failure_alert(spark, al.GOLD_LOADER, al.GOLD_FAILED, snapshots, str(e), run.run_ts), run)
        raise


def read_ledger(spark: SparkSession, run: Run, state: pub.State | None = None) -> DataFrame:
    """The processed snapshots, from the published state; ``ledger`` is a copy that other tools can read."""
    state = state or pub.head(spark, run.path("gold"))
    published = spark.createDataFrame(list(state.snapshots.items()), "snapshot_date string, at string").select(
        SNAPSHOT, F.col("at").cast("timestamp_ntz").alias("processed_at"))
    plain = read_table(spark, run.path("ledger"), PROCESSED_SCHEMA)
    return published.unionByName(plain.join(published, SNAPSHOT, "left_anti"))


def _settle(spark: SparkSession, run: Run, state: pub.State) -> None:
    """Finish what follows a publication: replaced files go, the ledger's copy is completed."""
    pub.settle(spark, run.path("gold"), state)
    copied = {r[0] for r in read_table(spark, run.path("ledger"), PROCESSED_SCHEMA).select(SNAPSHOT).collect()}
    rows = [(s, at) for s, at in state.snapshots.items() if s not in copied]
    if rows:
        (spark.createDataFrame(rows, f"{SNAPSHOT} string, at string").select(SNAPSHOT, F.col("at").cast("timestamp_ntz").alias("processed_at"))
         .coalesce(1).write.mode("append").parquet(run.path("ledger")))


def _load_gold(spark: SparkSession, cfg: DatasetConfig, run: Run, snapshots: Sequence[str],
               version: str | None, force: bool) -> None:
    version = version or registered_contract(spark, cfg, run).first()["version"]
    path, by = run.path("gold"), cfg.gold_partition
    state = pub.head(spark, path)
    if state.number:
        _settle(spark, run, state)
    pending = gold.pending_snapshots(_wanted(spark, snapshots), read_ledger(spark, run, state))
    unmarked = [r[0] for r in pending.collect()]
    todo = list(snapshots) if force else unmarked
    skipped = [s for s in snapshots if s not in todo]
    alerts, loaded = [al.already_processed(_wanted(spark, skipped), run.run_ts)] if skipped else [], []
    if todo:
        rows = cleaning.enforce_types(_layer(spark, run, "silver", cfg, todo), cfg.contract)
        # partition values and one column: which snapshots have rows, and which partitions they touch
        touches = rows.select(F.col(SNAPSHOT).cast("string").alias("_s"), F.col(by).alias("_by")).distinct().collect()
        full = {r["_s"] for r in touches}
        loaded = [s for s in todo if s in full]
        empty = [s for s in todo if s not in full]
        if empty:
            alerts.append(al.silver_empty(_wanted(spark, empty), run.run_ts))
    if loaded:
        source = gold.tag_version(rows, version)
        target = pub.read_published(spark, path, source.select(*cfg.gold_columns).schema, state)
        values = {r["_by"] for r in touches}
        hit = F.col(by).isin([v for v in values if v is not None])
        target = target.where(hit | F.col(by).isNull() if None in values else hit)
        merged = cut_lineage(gold.merge(target, source, cfg.gold_keys, [SNAPSHOT, *ORDER_COLUMNS]))
        counts = gold.merge_counts(merged, by)
        alerts.append(al.gold_loaded(counts.withColumnRenamed(by, SNAPSHOT), version, run.run_ts))
        marked = {s: run.run_ts for s in loaded if s in unmarked}
        state = pub.publish(merged.select(*cfg.gold_columns).hint("rebalance", by), path, by, state, marked)
        _settle(spark, run, state)
    if alerts:
        _emit(al.union_alerts(alerts), run)


def compact_history(spark: SparkSession, run: Run, snapshots: Sequence[str] | None = None, limit: int = 32) -> None:
    """Compact the metric history of snapshots that ran so often that they have more than ``limit`` files."""
    for kind in pub.listed(spark, run.path("metrics")):
        mt.compact_metrics(spark, run.path("metrics", kind), snapshots, limit)


def run_all(spark: SparkSession, cfg: DatasetConfig, run: Run,
            snapshots: Sequence[str] | None = None) -> None:
    """Ingest to Gold in order; the first gate that refuses stops the run."""
    snapshots = ingest(spark, cfg, run, snapshots)
    validate_and_clean(spark, cfg, run, snapshots)
    version = enforce_schema(spark, cfg, run, snapshots)
    check_quality(spark, cfg, run, snapshots)
    run_profiling(spark, cfg, run, snapshots)
    build_baseline(spark, cfg, run, snapshots)
    detect_drift(spark, cfg, run, snapshots)
    load_gold(spark, cfg, run, snapshots, version)
    compact_history(spark, run, snapshots)
