"""Exact linear-interpolated quantiles per group, safe for groups of any size.

A snapshot that holds a third of a very large table cannot be sorted in one task, so
:func:`select_quantiles` finds the wanted order statistics by narrowing. Count the group's values in buckets, keep the buckets that hold a wanted rank, and
split those again until few enough values are left to sort. Each round is one partially
aggregated count, so a task never holds more than the buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapgate.sinks.scratch import cut_lineage

SMALL_GROUP_ROWS = 250_000   # values one task may sort per group and column
_LOG_STEPS = 64              # buckets per factor of e in the first round
_LOG_OFFSET = 60_000         # above 64 * |ln(x)| for every finite double
_SPLIT = 4096                # equal-width parts per bucket in later rounds


def sorted_values(column: str) -> Column:
    """Aggregate: a group's values in order. Only for groups counted small."""
    return F.sort_array(F.collect_list(column))


def _pairs(columns: Sequence[str]) -> Column:
    return F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]))


def long_values(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``(by, column, value)`` without NULL and NaN."""
    return df.select(*by, _pairs(columns)).where(F.col("value").isNotNull() & ~F.isnan("value"))


def bucket_table(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``(by, column, _b, n, lo, hi, mean, m2)``: the values in buckets of equal relative width, in one pass.

    ``m2`` is the sum of squared deviations in the bucket. NULL and NaN lie in a bucket without a
    number, which counts none.
    """
    value = F.when(~F.isnan("value"), F.col("value"))
    rows = df.select(*by, _pairs(columns)).withColumn("value", value)
    return rows.groupBy(*by, "column", log_bucket(F.col("value")).alias("_b")).agg(
        F.count("value").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.avg("value").alias("mean"),
        (F.var_pop("value") * F.count("value")).alias("m2"))


def pooled(entries: Column) -> Column:
    """(n, mean, m2) of an array of such structs taken together, by the pairwise rule."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a, b):
        n = a["n"] + b["n"]
        apart = b["mean"] - a["mean"]
        both = F.struct(n.alias("n"), (a["mean"] + apart * b["n"] / n).alias("mean"),
                        (a["m2"] + b["m2"] + apart * apart * a["n"] * b["n"] / n).alias("m2"))
        return F.when(b["n"] > 0, both).otherwise(a)
    return F.aggregate(entries, start, add)


def log_bucket(v):
    """Non-decreasing in ``v``: equal relative width, negative values mirrored."""
    size = F.lit(_LOG_OFFSET) + F.floor(F.least(F.ln(F.abs(v)), F.lit(800.0)) * _LOG_STEPS)
    return F.when(v == 0, F.lit(0).cast("bigint")).when(v > 0, size).otherwise(-size)


def pick(hist: DataFrame, keys: list[str], order: str, targets: DataFrame | None,
          probs: Sequence[float]) -> DataFrame:
    """The buckets holding each wanted rank, with the rank made relative to the bucket.

    ``hist`` has ``(keys, order, n, lo, hi)`` and at most one round's buckets per group.
    """
    running = Window.partitionBy(*keys).orderBy(order)
    cum = hist.withColumn("_end", F.sum("n").over(running.rowsBetween(Window.unboundedPreceding, 0)))
    if targets is None:
        total = F.sum("n").over(Window.partitionBy(*keys))
        at = [F.lit(p) * (F.col("_total") - 1) for p in probs]
        wanted = F.array(*[
            F.struct(F.lit(p).alias("prob"), F.lit(side).alias("side"),
                     edge(h).alias("rank"), (h - F.floor(h)).alias("frac"))
            for p, h in zip(probs, at) for side, edge in (("lo", F.floor), ("hi", F.ceil))])
        cum = cum.withColumn("_total", total).select("*", F.inline(wanted))
    else:
        cum = cum.join(targets.select(*keys, "prob", "side", "rank", "frac"), keys)
    start = F.col("_end") - F.col("n")
    hit = cum.where((F.col("rank") >= start) & (F.col("rank") < F.col("_end")))
    return hit.select(*keys, order, "prob", "side", "frac", (F.col("rank") - start).alias("rank"),
                      "lo", "hi", "n")


def select_quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str],
                     probs: Sequence[float], sort_rows: int = SMALL_GROUP_ROWS, buckets: DataFrame | None = None,
                     members: DataFrame | None = None) -> DataFrame:
    """``(by, column, prob, value)`` exact for groups of any size and any value skew.

    Round one uses buckets of equal relative width, which needs no knowledge of the data;
    later rounds split the remaining range ``[lo, hi]`` of a bucket into equal parts. A
    bucket is done when its smallest and largest value agree, so repeated values end at once,
    or when it is counted to hold at most ``sort_rows`` values, which are then sorted. Every
    round scans ``df`` again, column-pruned: give it a stored table. ``buckets`` is the
    :func:`bucket_table` of it where that is at hand.

    With ``members``, a stored table of different pairs ``(by, member)``, a group has the rows of all
    its members, which are the groups of ``df`` by the one column in ``by``. A member's values are
    counted once whatever the number of groups it is in, and only those in a range that a group
    wants are repeated for it.
    """
    by = list(by)
    keys = [*by, "column"]
    hist = (bucket_table(df, by, columns) if buckets is None else buckets).where("n > 0").select(*keys, "_b", "n", "lo", "hi")
    values, at = long_values(df, by, columns).withColumn("_b", log_bucket(F.col("value"))), [*keys, "_b"]
    if members is not None:
        hist = (hist.withColumnRenamed(by[0], "member").join(members, "member").groupBy(*keys, "_b")
                .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
        values, at = values.withColumnRenamed(by[0], "member"), ["member", "column", "_b"]
    targets = cut_lineage(pick(hist, keys, "_b", None, probs))
    fields = [*keys, "prob", "side", "frac", "rank", "lo", "hi", "n"]
    ranges = [*keys, "_lo", "_hi"]
    done = targets.where("lo = hi").select(*fields)
    todo = targets.where("lo < hi")
    largest = _largest(todo)
    while largest:
        inside = _inside(values, todo if "member" not in at else todo.join(members, by), keys, at)
        wanted = todo.select(*fields).withColumnsRenamed({"lo": "_lo", "hi": "_hi"})
        if largest <= sort_rows:
            ordered = inside.groupBy(*ranges).agg(sorted_values("value").alias("_v"))
            value = F.get("_v", F.col("rank").cast("int"))
            found = wanted.drop("n").join(ordered, ranges).select(
                *keys, "prob", "side", "frac", "rank", value.alias("lo"), value.alias("hi"),
                F.lit(1).cast("bigint").alias("n"))
            done = done.unionByName(found)
            break
        # halving before subtracting keeps the width finite for the widest buckets
        part = F.floor((F.col("value") / 2 - F.col("_lo") / 2)
                       / (F.col("_hi") / 2 - F.col("_lo") / 2) * _SPLIT)
        values, at = inside.withColumn("_b", F.least(part, F.lit(_SPLIT - 1))), [*ranges, "_b"]
        hist = values.groupBy(*ranges, "_b").agg(F.count("*").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
        targets = cut_lineage(pick(hist, ranges, "_b", wanted, probs))
        done = done.unionByName(targets.where("lo = hi").select(*fields))
        todo = targets.where("lo < hi")
        largest = _largest(todo)
    low, high = (F.max(F.when(F.col("side") == s, F.col("lo"))) for s in ("lo", "hi"))
    return (done.groupBy(*keys, "prob").agg(low.alias("_l"), high.alias("_h"),
                                            F.max("frac").alias("_f"))
            .select(*keys, "prob",
                    F.when(F.col("_l") == F.col("_h"), F.col("_l"))
                    .otherwise(F.col("_l") + (F.col("_h") - F.col("_l")) * F.col("_f")).alias("value")))


def _largest(todo: DataFrame) -> int:
    return todo.agg(F.max("n")).first()[0] or 0


def _inside(values: DataFrame, todo: DataFrame, keys: list[str], at: list[str]) -> DataFrame:
    """``(keys, value, _lo, _hi)``: the values in a wanted bucket, with its least and largest value.

    ``at`` names a value's bucket, so a value is looked up in one equality join whatever the number
    of ranges; ``todo`` is a stored table, broadcast when its measured size allows.
    """
    ends = todo.select(*dict.fromkeys([*keys, *at]), F.struct("lo", "hi").alias("_r")).distinct()
    return values.join(ends, at).select(*keys, "value", F.col("_r.lo").alias("_lo"), F.col("_r.hi").alias("_hi"))
