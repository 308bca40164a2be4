"""Profile state that merges: what a window of snapshots needs of each, without reading their rows.

Statistics of several snapshots taken together are not means of their statistics. Stored beside a
profile, these states give them: moments by the pairwise rule, quantiles from counts of values in
buckets of equal relative width, distinct counts from sketches. Each state is bounded whatever the
snapshot's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from snapgate.functions.text import nan_to_null
from snapgate.operators.quantiles import bucket_table, pick, pooled

#: Bits of a distinct sketch's index: 2**12 registers, a standard error of 1.6 %, 4 kB at most.
SKETCH_BITS = 12


def pooled_moments(history: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """``(by, column, rows, pooled_mean, pooled_std)`` over all rows of the profiles in the history.

    Needs the count, mean and population standard deviation of each. They are pooled in order, so
    a repeated run gives the same digits; a window without values has no mean and no deviation.
    """
    each = F.struct(F.coalesce("count", F.lit(0)).cast("bigint").alias("n"), F.coalesce("mean", F.lit(0.0)).alias("mean"),
                    F.coalesce(F.col("std") * F.col("std") * F.col("count"), F.lit(0.0)).alias("m2"))
    # one entry for each snapshot of the window
    state = history.groupBy(by, "column").agg(pooled(F.sort_array(F.collect_list(each))).alias("s"))
    some = F.col("s.n") > 0
    return state.select(by, "column", F.col("s.n").alias("rows"), F.when(some, F.col("s.mean")).alias("pooled_mean"),
                        F.when(some, F.sqrt(F.col("s.m2") / F.col("s.n"))).alias("pooled_std"))


def bucket_counts(df: DataFrame, columns: Sequence[str], by: str = "snapshot_date") -> DataFrame:
    """``(by, column, buckets)``: how many values lie in each bucket, the least and the largest of them.

    A bucket is a 64th of a factor of e wide, so there are as many as the values' magnitudes need,
    a few hundred for most columns and never more than 200,000. One partially aggregated pass.
    """
    return as_buckets(bucket_table(df, [by], [c for c in columns if c in df.columns]), by)


def as_buckets(table: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """The :func:`quantiles.bucket_table` of a profile as an array in each record."""
    bucket = F.when(F.col("n") > 0, F.struct(F.col("_b").cast("int").alias("b"), "n", "lo", "hi"))
    return table.groupBy(by, "column").agg(F.sort_array(F.collect_list(bucket)).alias("buckets"))


def window_quantiles(history: DataFrame, probs: Sequence[float], by: str = "snapshot_date") -> DataFrame:
    """``(by, column, prob, rows, value, low, high)`` over all rows of the history's bucket counts.

    The exact quantile, linearly interpolated, lies between ``low`` and ``high``, which are values
    that occur; when they lie in one bucket they are less than 1.6 % apart. Where a bucket's
    values are all equal the result is exact.
    """
    merged = (history.select(by, "column", F.inline("buckets")).groupBy(by, "column", "b")
              .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
    rows = merged.groupBy(by, "column").agg(F.sum("n").alias("rows"))
    at = pick(merged, [by, "column"], "b", None, probs)
    inner = F.col("lo") + (F.col("hi") - F.col("lo")) * F.when(F.col("n") > 1, F.col("rank") / (F.col("n") - 1)).otherwise(0.0)
    low, high = (F.max(F.when(F.col("side") == s, F.struct(inner.alias("v"), "lo", "hi"))) for s in ("lo", "hi"))
    ends = at.groupBy(by, "column", "prob").agg(low.alias("l"), high.alias("h"), F.max("frac").alias("f"))
    return ends.join(rows, [by, "column"]).select(
        by, "column", "prob", "rows", (F.col("l.v") + (F.col("h.v") - F.col("l.v")) * F.col("f")).alias("value"),
        F.col("l.lo").alias("low"), F.col("h.hi").alias("high"))


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: str = "snapshot_date", bits: int = SKETCH_BITS) -> DataFrame:
    """``(by, column, distinct_sketch)``: a sketch of each column's distinct values, as base64 text. One pass."""
    columns = [c for c in columns if c in df.columns]
    sketches = df.groupBy(by).agg(*[F.hll_sketch_agg(nan_to_null(df, c).cast("string"), bits).alias(f"s{i}") for i, c in enumerate(columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.base64(F.col(f"s{i}")).alias("distinct_sketch")) for i, c in enumerate(columns)])
    return sketches.select(by, F.inline(rows))


def window_distinct(history: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """``(by, column, distinct_values)`` over all rows of the history's sketches, within a few percent."""
    united = F.hll_union_agg(F.unbase64("distinct_sketch"))
    return history.groupBy(by, "column").agg(F.hll_sketch_estimate(united).alias("distinct_values"))
