"""Column profiles per snapshot: numeric statistics, value counts, top values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from snapgate.functions.text import nan_to_null
from snapgate.operators.quantiles import SMALL_GROUP_ROWS, bucket_table, pooled, select_quantiles
from snapgate.sinks.scratch import cut_lineage

# The numeric statistics and their order in a profile record.
NUMERIC_METRICS = ["count", "mean", "median", "std", "min", "max", "p25", "p50", "p75"]
QUANTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def missing_profile_columns(df: DataFrame, wanted: Sequence[str], by: str = "snapshot_date") -> DataFrame:
    """One row per snapshot and wanted column that is absent; such columns are skipped."""
    absent = [c for c in wanted if c not in df.columns]
    names = F.array(*[F.lit(c) for c in absent]) if absent else F.array().cast("array<string>")
    return (df.groupBy(by).agg(F.count("*").alias("row_count"))
            .select(by, "row_count", F.explode(names).alias("column")))


def profile_numeric(df: DataFrame, columns: Sequence[str], by: str = "snapshot_date",
                    sort_rows: int = SMALL_GROUP_ROWS) -> DataFrame:
    """``(by, column, count, mean, median, std, min, max, p25, p50, p75)``, all exact.

    One pass over the pruned columns counts values in buckets, and from these come all statistics
    and the first narrowing round of the quantiles. Only ranges that hold a wanted rank among
    different values are read again, and never more than ``sort_rows`` values sorted in one task.
    NaN counts as missing. Standard deviation is that of the population, 0.0 below two values.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return no_rows(df, by, "column string, count bigint, "
                       + ", ".join(f"{m} double" for m in NUMERIC_METRICS[1:]))
    return numeric_profile(*numeric_buckets(df, columns, by), columns, by, sort_rows)


def numeric_buckets(df: DataFrame, columns: Sequence[str], by: str = "snapshot_date") -> tuple[DataFrame, DataFrame]:
    """The columns as doubles and their stored :func:`quantiles.bucket_table`."""
    data = df.select(by, *[nan_to_null(df, c).cast("double").alias(c) for c in columns])
    return data, cut_lineage(bucket_table(data, [by], columns))


def numeric_profile(data: DataFrame, buckets: DataFrame, columns: Sequence[str], by: str = "snapshot_date",
                    sort_rows: int = SMALL_GROUP_ROWS) -> DataFrame:
    """:func:`profile_numeric` of what :func:`numeric_buckets` gives."""
    # a bucket is a 64th of a factor of e, so a group has some hundreds of them
    moments = pooled(F.sort_array(F.collect_list(F.when(F.col("n") > 0, F.struct("n", "mean", "m2")))))
    out = buckets.groupBy(by, "column").agg(moments.alias("_m"), F.min("lo").alias("min"), F.max("hi").alias("max"))
    some = F.col("_m.n") > 0
    out = out.select(by, "column", F.col("_m.n").alias("count"), F.when(some, F.col("_m.mean")).alias("mean"),
                     F.when(some, F.sqrt(F.col("_m.m2") / F.col("_m.n"))).otherwise(0.0).alias("std"), "min", "max")
    found = select_quantiles(data, [by], columns, list(QUANTILES.values()), sort_rows, buckets)
    found = found.groupBy(by, "column").agg(*[
        F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name)
        for name, p in QUANTILES.items()])
    out = out.join(found, [by, "column"], "left")
    return out.withColumn("median", F.col("p50")).select(by, "column", *NUMERIC_METRICS)


def cover_profiles(known: DataFrame, profile: DataFrame, columns: Sequence[str],
                   by: str = "snapshot_date") -> DataFrame:
    """``profile`` with a record of count 0 for every known snapshot and column without one."""
    wanted = known.select(by).distinct().select(by, F.explode(F.array(*[F.lit(c) for c in columns])).alias("column"))
    zeros = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("count", "cardinality") if c in profile.columns}
    if "std" in profile.columns:
        zeros["std"] = F.coalesce("std", F.lit(0.0))
    if "top_5_values" in profile.columns:
        zeros["top_5_values"] = F.coalesce("top_5_values", F.create_map().cast("map<string,bigint>"))
    return wanted.join(profile, [by, "column"], "left").withColumns(zeros)


def no_rows(df: DataFrame, by: str, fields: str) -> DataFrame:
    schema = T.StructType([df.schema[by], *T.StructType.fromDDL(fields).fields])
    return df.sparkSession.createDataFrame([], schema)


def _counts(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Counts of all values, missing ones as a NULL value; pre-aggregated per task."""
    columns = [c for c in columns if c in df.columns]
    pairs = F.array(*[F.struct(F.lit(c).alias("column"),
                               nan_to_null(df, c).cast("string").alias("value")) for c in columns])
    return (df.select(by, F.inline(pairs))
            .groupBy(by, "column", "value").agg(F.count("*").alias("n")))


def value_counts(df: DataFrame, columns: Sequence[str], by: str = "snapshot_date") -> DataFrame:
    """``(by, column, value, n)`` of non-missing values, as text."""
    return _counts(df, columns, by).where("value is not null")


def top_values(counts: DataFrame, k: int = 5, by: str = "snapshot_date") -> DataFrame:
    """The ``k`` most frequent values with their rank; equal counts rank by value.

    The rank filter limits each task to ``k`` rows per column ahead of the shuffle.
    """
    w = Window.partitionBy(by, "column").orderBy(F.col("n").desc(), F.col("value").asc())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def profile_categorical(df: DataFrame, columns: Sequence[str], by: str = "snapshot_date",
                        k: int = 5) -> DataFrame:
    """``(by, column, count, cardinality, top_5_values)``; the map holds the ``k`` top values.

    A column without any value in a snapshot still has a row, with count 0. The value counts,
    the one pass and shuffle over the rows, are stored; totals and ranks are read off them.
    """
    if not any(c in df.columns for c in columns):
        return no_rows(df, by, "column string, count bigint, cardinality bigint, "
                                "top_5_values map<string,bigint>")
    counts = cut_lineage(_counts(df, columns, by))
    totals = counts.groupBy(by, "column").agg(
        F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("count"),
        F.count("value").alias("cardinality"))
    ranked = F.sort_array(F.collect_list(F.struct("rank", "value", "n")))  # k entries
    entries = F.transform(ranked, lambda r: F.struct(r["value"], r["n"]))
    top = (top_values(counts.where("value is not null"), k, by).groupBy(by, "column")
           .agg(F.map_from_entries(entries).alias("top_5_values")))
    no_values = F.create_map().cast("map<string,bigint>")
    return totals.join(top, [by, "column"], "left").select(
        by, "column", "count", "cardinality",
        F.coalesce("top_5_values", no_values).alias("top_5_values"))
