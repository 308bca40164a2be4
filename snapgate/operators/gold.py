"""Gold: pending snapshots, last-wins source, keyed upsert, ledger."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from snapgate.operators.cleaning import keep_first, keep_last

def pending_snapshots(snapshots: DataFrame, ledger: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Snapshots the ledger does not list as processed."""
    return snapshots.select(by).distinct().join(ledger.select(by).distinct(), by, "left_anti")


def pending_rows(silver: DataFrame, ledger: DataFrame, by: str = "snapshot_date") -> DataFrame:
    return silver.join(ledger.select(by).distinct(), by, "left_anti")


def tag_version(df: DataFrame, version: str) -> DataFrame:
    return df.withColumn("schema_version", F.lit(version))


def last_wins(source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The state after applying the source rows one by one: the last row of each key."""
    return keep_last(source, keys, order)


def touched(target: DataFrame, source: DataFrame, by: str) -> DataFrame:
    """Target rows in the partitions the source has rows for.

    A semi join, whose small side prunes the partitions at run time. Rows without a partition
    value lie in a partition of their own, which a source row without one touches.
    """
    values = source.select(by).distinct()
    known = target.join(values, by, "left_semi")
    lost, touching = target.where(F.col(by).isNull()), values.where(F.col(by).isNull())
    return known.unionByName(lost.join(touching, lost[by].eqNullSafe(touching[by]), "left_semi"))


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           order: Sequence[str]) -> DataFrame:
    """``target`` with the source rows inserted, or replacing the row of the same key.

    One shuffle: both sides are put together and each key keeps its last source row, else
    its target row. Applying the same source again changes nothing.
    """
    cols = target.columns
    tagged = (target.withColumn("_prio", F.lit(0))
              .unionByName(source.withColumn("_prio", F.lit(1)), allowMissingColumns=True))
    by_order = [F.col("_prio").desc(), *[F.col(c).desc() for c in order]]
    return keep_first(tagged, keys, by_order).select(*cols)


def merge(target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """:func:`upsert` with what became of each key: ``_source_rows`` of them were merged, ``_known`` if the target had it.

    One shuffle, partially aggregated, so that a key of very many rows never meets in one task.
    Store the result and both the rows and :func:`merge_counts` come from one pass.
    """
    others = [c for c in target.columns if c not in keys]
    tagged = (target.withColumn("_prio", F.lit(0))
              .unionByName(source.withColumn("_prio", F.lit(1)), allowMissingColumns=True))
    newest = F.max_by(F.struct(*others), F.struct("_prio", *order))
    merged = tagged.groupBy(*keys).agg(newest.alias("_row"), F.sum("_prio").alias("_source_rows"),
                                       (F.min("_prio") == 0).alias("_known"))
    return merged.select(*(F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in target.columns),
                         "_source_rows", "_known")


def merge_counts(merged: DataFrame, by: str) -> DataFrame:
    """:func:`upsert_counts` of a :func:`merge`."""
    hit = F.col("_source_rows") > 0
    return merged.groupBy(by).agg(
        F.sum("_source_rows").alias("source_rows"), F.count_if(hit).alias("distinct_keys"),
        F.count_if(hit & ~F.col("_known")).alias("inserted"), F.count_if(hit & F.col("_known")).alias("updated"))


def upsert_counts(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  by: str) -> DataFrame:
    """Per snapshot: source rows, distinct keys, inserted and updated keys."""
    groups = list(dict.fromkeys([by, *keys]))
    sides = (target.select(*groups, F.lit(0).alias("_s"))
             .unionByName(source.select(*groups, F.lit(1).alias("_s"))))
    per_key = sides.groupBy(*groups).agg(F.sum("_s").alias("_src"), F.min("_s").alias("_new"))
    hit = F.col("_src") > 0
    return per_key.groupBy(by).agg(
        F.sum("_src").alias("source_rows"),
        F.count_if(hit).alias("distinct_keys"),
        F.count_if(hit & (F.col("_new") == 1)).alias("inserted"),
        F.count_if(hit & (F.col("_new") == 0)).alias("updated"))


def ledger_rows(loaded: DataFrame, run_ts: str, by: str = "snapshot_date") -> DataFrame:
    """Ledger entries for the snapshots of the loaded rows; an empty load marks nothing."""
    return loaded.select(by).distinct().withColumn(
        "processed_at", F.lit(run_ts).cast("timestamp_ntz"))
