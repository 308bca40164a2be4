"""Which snapshots exist, which is the newest, and which requested ones are absent."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def snapshot_paths(root: str, snapshots: Sequence[str] | None, by: str = "snapshot_date") -> list[str]:
    """The partition folders of the given snapshots, or the root for all of them."""
    if snapshots is None:
        return [root]
    return [f"{root.rstrip('/')}/{by}={s}" for s in snapshots]


def list_snapshots(spark: SparkSession, root: str, snapshots: Sequence[str] | None = None,
                   by: str = "snapshot_date") -> DataFrame:
    """The snapshots, all or of those given, that have files under ``root``.

    Taken from the file listing: one row per file, no file is opened. A root that does not
    exist has no snapshots.
    """
    wanted = [p for p in snapshot_paths(root, snapshots, by) if path_exists(spark, p)]
    if not wanted:
        return spark.createDataFrame([], f"{by} string")
    files = spark.read.format("binaryFile").option("basePath", root).load(wanted)
    if by not in files.columns:
        return spark.createDataFrame([], f"{by} string")
    return files.select(F.col(by).cast("string").alias(by)).distinct()


def discover_snapshots(df: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """The distinct snapshots in ascending order; reads only the snapshot column."""
    return df.select(by).distinct().orderBy(by)


def latest_snapshot(df: DataFrame, by: str = "snapshot_date"):
    """The newest snapshot as a value for a pruning filter; None when there is none."""
    return df.agg(F.max(by)).first()[0]


def rows_of_latest(df: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """The rows of the newest snapshot; its value is fetched first so that the filter prunes."""
    newest = latest_snapshot(df, by)
    return df.where(F.col(by) == F.lit(newest))


def missing_snapshots(requested: DataFrame, df: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Requested snapshots that have no data."""
    return requested.select(by).distinct().join(df.select(by).distinct(), by, "left_anti")


def require_snapshots(spark: SparkSession, root: str, snapshots: Sequence[str], what: str,
                      by: str = "snapshot_date") -> None:
    """Fail unless every snapshot has files under ``root``."""
    wanted = spark.createDataFrame([(s,) for s in snapshots], f"{by} string")
    absent = [r[0] for r in missing_snapshots(wanted, list_snapshots(spark, root, snapshots, by), by)
              .orderBy(by).collect()]
    if absent:
        raise FileNotFoundError(f"missing {what} data for snapshots {absent}")


def cover(known: DataFrame, measured: DataFrame, zeros: Sequence[str], by: str = "snapshot_date") -> DataFrame:
    """``measured`` with a row for every known snapshot; ``zeros`` are 0 where there were no rows."""
    joined = known.select(by).distinct().join(measured, by, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zeros})


def empty_snapshots(known: DataFrame, df: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Known snapshots with zero rows in ``df``: nothing to load, not to be marked processed."""
    counts = df.groupBy(by).agg(F.count("*").alias("row_count"))
    return (known.select(by).distinct().join(counts, by, "left")
            .select(by, F.coalesce("row_count", F.lit(0)).cast("bigint").alias("row_count"))
            .where("row_count = 0"))
