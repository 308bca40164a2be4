"""Add files that arrive after their snapshot was ingested, without running the snapshot again.

A file stream finds the new files. Of each micro-batch only these files are read; what Bronze and
Silver hold of the touched snapshots is their state, looked at by key columns alone: a file Bronze
has is not added twice, and a row gives way to the row of its key that was delivered before it, as
keep-first does in one delivery. Rows are added to the snapshots' partitions. A time limit ends a
snapshot's state: files for one that many days older than the newest are alerted and left.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from snapgate.config import DatasetConfig
from snapgate.operators import alerts as al, cleaning
from snapgate.sinks.layers import write_layer
from snapgate.sinks.scratch import cut_lineage
from snapgate.sources.raw import ORDER_COLUMNS, SNAPSHOT, read_layer, read_raw, stamp
from snapgate.sources.snapshots import latest_snapshot, list_snapshots
from snapgate.streaming.incremental import LISTING


def _held(spark: SparkSession, cfg: DatasetConfig, path: str, snapshots: list[str]) -> DataFrame | None:
    """What a layer has of the snapshots; None where it has nothing."""
    there = [r[0] for r in list_snapshots(spark, path, snapshots).collect()]
    return read_layer(spark, path, cfg.layer_format, there, cfg.raw_multi_line) if there else None


def add_files(spark: SparkSession, cfg: DatasetConfig, root: str, files: list[tuple[str, str]], run_ts: str) -> list[str]:
    """Add raw files, given as (path, snapshot), to Bronze and Silver; returns the snapshots. Safe to repeat."""
    root = root.rstrip("/")
    snapshots = sorted({s for _, s in files})
    rows = stamp(read_raw(spark, f"{root}/raw", cfg.raw_format, multi_line=cfg.raw_multi_line, files=[p for p, _ in files]), run_ts)
    bronze, silver = (_held(spark, cfg, f"{root}/{layer}", snapshots) for layer in ("bronze", "silver"))
    rows = cut_lineage(rows)
    fresh = rows if bronze is None else cleaning.new_keys(rows, bronze, ["_src_file"])
    write_layer(cut_lineage(fresh), f"{root}/bronze", cfg.layer_format, append=True)
    keys = [SNAPSHOT, *cfg.dedup_keys]
    clean = cleaning.clean(rows, cfg.contract, keys, ORDER_COLUMNS)
    if silver is not None:
        clean = cleaning.new_keys(clean, cleaning.enforce_types(silver, cfg.contract), keys)
    write_layer(cut_lineage(clean), f"{root}/silver", cfg.layer_format, rebalance=True, append=True)
    return snapshots


def add_late_files(spark: SparkSession, cfg: DatasetConfig, root: str, checkpoint: str, run_ts: str, within_days: int = 7) -> None:
    """Add every raw file that arrived since the last call to its snapshot, then return.

    A micro-batch that fails is tried again by the next call. The jobs behind Silver run on the
    touched snapshots as usual.
    """
    files = spark.readStream.format("binaryFile").schema(LISTING).load(f"{root.rstrip('/')}/raw")

    def batch(new: DataFrame, batch_id: int) -> None:
        found = sorted((r["path"], r[SNAPSHOT]) for r in new.select("path", SNAPSHOT).collect())
        newest = latest_snapshot(list_snapshots(spark, f"{root.rstrip('/')}/raw"))
        if not found or newest is None:
            return
        oldest = (datetime.date.fromisoformat(newest) - datetime.timedelta(days=within_days)).isoformat()
        late = [f for f in found if f[1] < oldest]
        if late:
            alerts = al.late_files(spark.createDataFrame(late, f"path string, {SNAPSHOT} string"), run_ts)
            alerts.write.mode("append").json(f"{root.rstrip('/')}/alerts")
        taken = [f for f in found if f[1] >= oldest]
        if taken:
            add_files(spark, cfg, root, taken, run_ts)

    query = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
