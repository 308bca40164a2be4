"""Exact top values of columns with any number of values, in bounded memory.

Counting every value moves a nearly unique column through a shuffle to find five of its values.
Here each task keeps a summary of at most ``counters`` values per snapshot and column
(Misra-Gries: when there are more, the smallest count that would not fit is taken from all). A
summary counts no value too high and none too low by more than what was taken, and that holds for
the sums over all tasks. So only values whose summed count comes within the error of the k-th best
can be among the top; these few are counted exactly in a second pass. Where even a value no
summary holds could reach the k-th best, the proof fails and the column is read again with more
counters, at last with all its values.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from snapgate.functions.text import nan_to_null
from snapgate.operators.profile import no_rows, top_values
from snapgate.sinks.scratch import cut_lineage

# executors get this module's functions with the job, not from a package they would have to have
cloudpickle.register_pickle_by_value(sys.modules[__name__])

COUNTERS = 1024
ROUNDS = 2
GROWTH = 16


#: Counted values a task holds of a column before it makes a summary of them, in multiples of the summary.
HELD = 4
#: Counted values a task holds of a column before it passes their counts on, where all values are counted.
PASSED = 1 << 18
#: Values one task counts, where all are.
COUNTED = 500_000
#: At most so many such tasks: a shuffle to more of them holds its rows in memory to sort them.
MOST_TASKS = 200


def trimmed(group: np.ndarray, counts: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What stays of each group's counts, at most ``counters``: their places, lowered counts, and the amounts taken.

    ``group`` numbers the groups from 0. All counts of a group are lowered alike.
    """
    order = np.lexsort((-counts, group))
    size = np.bincount(group)
    begin = np.cumsum(size) - size
    taken = np.zeros(len(size), np.int64)
    full = np.flatnonzero(size > counters)
    taken[full] = counts[order[begin[full] + counters]]
    left = counts - taken[group]
    stay = np.flatnonzero(left > 0)
    return stay, left[stay], taken


def _keyed(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """``by`` as a text that is never NULL, and the columns as text, c0 and on."""
    key = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit("null")).alias("by")
    return df.select(key, *[nan_to_null(df, c).cast("string").alias(f"c{i}") for i, c in enumerate(columns)])


def _counts_of(table: pa.Table, column: str) -> pa.Table:
    """``(by, value, n)`` of the values that a column has in a table."""
    counted = table.select(["by", column]).group_by(["by", column]).aggregate([([], "count_all")])
    counted = counted.filter(counted.column(column).is_valid())
    return pa.table(dict(zip(("by", "value", "n"), (counted.column(c) for c in ("by", column, "count_all")))))


def _added(tables: list[pa.Table]) -> pa.Table:
    """Tables ``(by, value, n)`` as one, a row for each value."""
    table = pa.concat_tables(tables).group_by(["by", "value"]).aggregate([("n", "sum")])
    return pa.table(dict(zip(("by", "value", "n"), (table.column(c) for c in ("by", "value", "n_sum")))))


def summaries(df: DataFrame, columns: Sequence[str], by: str = "snapshot_date", counters: int = COUNTERS,
              only: set | None = None) -> DataFrame:
    """``(by, column, value, n)``: each task's summaries; the row without a value has what was taken.

    NULL and NaN are no values. ``only`` restricts to pairs of the text of ``by`` and a column.
    """
    names = list(columns)

    def run(batches):
        held = [[] for _ in names]
        errors = [{} for _ in names]

        def summary(i):
            """The counted values held of a column as one summary for each group."""
            table = _added(held[i])
            if only is not None:
                mine = pa.array([key for key, column in only if column == names[i]], pa.string())
                table = table.filter(pc.is_in(table.column("by"), mine))
            keys = table.column("by").combine_chunks().dictionary_encode()
            stay, n, taken = trimmed(keys.indices.to_numpy(), table.column("n").to_numpy(), counters)
            for key, amount in zip(keys.dictionary.to_pylist(), taken.tolist()):
                errors[i][key] = errors[i].get(key, 0) + amount
            return table.take(pa.array(stay)).set_column(2, "n", pa.array(n))

        for batch in batches:
            table = pa.Table.from_batches([batch])
            for i in range(len(names)):
                held[i].append(_counts_of(table, f"c{i}"))
                if sum(map(len, held[i])) > HELD * counters * max(len(errors[i]), 16):
                    held[i] = [summary(i)]
        for i, column in enumerate(names):
            if held[i]:
                table = summary(i)
                keys = list(errors[i])
                yield from pa.table({
                    "by": pa.chunked_array([*table.column("by").chunks, pa.array(keys, pa.string())]),
                    "column": pa.array([column] * (len(table) + len(keys)), pa.string()),
                    "value": pa.chunked_array([*table.column("value").chunks, pa.nulls(len(keys), pa.string())]),
                    "n": pa.chunked_array([*table.column("n").chunks, pa.array(list(errors[i].values()), pa.int64())]),
                }).combine_chunks().to_batches()

    return _keyed(df, names, by).mapInArrow(run, "by string, column string, value string, n long")


def candidates(summed: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """The values that can be among the top ``k``, and per group whether these are proven to be all.

    ``summed`` has a row for each group and value of all tasks' summaries.
    """
    ranked = Window.partitionBy("by", "column").orderBy(F.col("n").desc(), "value")
    best = summed.where("value is not null").withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    kth = best.groupBy("by", "column").agg(F.min(F.when(F.col("rank") == k, F.col("n"))).alias("kth"))
    error = summed.where("value is null").select("by", "column", F.col("n").alias("error"))
    # a value that no summary holds occurs at most ``error`` times
    proven = (F.col("error") == 0) | F.coalesce(F.col("error") < F.col("kth"), F.lit(False))
    proofs = cut_lineage(error.join(kth, ["by", "column"], "left").withColumn("proven", proven))
    near = summed.where("value is not null").join(proofs.where("proven"), ["by", "column"])
    return near.where(F.col("n") + F.col("error") >= F.coalesce("kth", F.lit(0))).select("by", "column", "value"), proofs


def partial_counts(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """``(by, column, value, n)``: each task's counts of all values; those of a value add up to its count.

    A task passes on what it holds of a column when that is more than ``PASSED`` values.
    """
    names = list(columns)

    def run(batches) -> Iterator[pa.RecordBatch]:
        held = [[] for _ in names]

        def rows(i):
            table = _added(held[i])
            held[i] = []
            return table.add_column(1, "column", pa.array([names[i]] * len(table), pa.string())).combine_chunks().to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            for i in range(len(names)):
                held[i].append(_counts_of(table, f"c{i}"))
                if sum(map(len, held[i])) > PASSED:
                    held[i] = [_added(held[i])]
                    if len(held[i][0]) > PASSED // 2:
                        yield from rows(i)
        for i in range(len(names)):
            if held[i]:
                yield from rows(i)

    return _keyed(df, names, by).mapInArrow(run, "by string, column string, value string, n long")


def _counted(df: DataFrame, columns: Sequence[str], by: str, wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    """Exact counts of the values ``wanted`` names; it is small and stored, so Spark broadcasts it by its size.

    Where it names columns, all their values are counted, by a task for every ``COUNTED`` of them, at most ``MOST_TASKS``:
    the size of a shuffle tells little of them, as such counts compress well.
    """
    if "value" not in on:
        values = sum(df.agg(*[F.count(nan_to_null(df, c)) for c in columns]).first())
        parts = partial_counts(df, columns, by).join(F.broadcast(wanted), list(on), "left_semi")
        dealt = parts.repartition(min(MOST_TASKS, max(1, math.ceil(values / COUNTED))), "by", "column", "value")
        return dealt.groupBy("by", "column", "value").agg(F.sum("n").alias("n"))
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("value")) for i, c in enumerate(columns)])
    values = _keyed(df, columns, by).select("by", F.inline(pairs)).where("value is not null")
    return values.join(wanted, list(on), "left_semi").groupBy("by", "column", "value").agg(F.count("*").alias("n"))


def top_values_bounded(df: DataFrame, columns: Sequence[str], k: int = 5, by: str = "snapshot_date",
                       counters: int = COUNTERS, rounds: int = ROUNDS) -> DataFrame:
    """``(by, column, value, n, rank)``: the same rows as :func:`profile.top_values` of all value counts.

    A task holds at most ``counters`` values per snapshot and column. A round that does not prove
    its result reads the columns left once more, with ``GROWTH`` times as many. What ``rounds``
    rounds leave, columns of which the k-th value is about as rare as all others, has all its
    values counted, ``COUNTED`` a task up to 200 tasks. Give it a stored table: it is read at least twice.
    """
    columns = [c for c in columns if c in df.columns]
    if not columns:
        return no_rows(df, by, "column string, value string, n bigint, rank int")
    parts, only = [], None
    for _ in range(rounds):
        summed = summaries(df, columns, by, counters, only).groupBy("by", "column", "value").agg(F.sum("n").alias("n"))
        near, proofs = candidates(cut_lineage(summed), k)
        parts.append(_counted(df, columns, by, cut_lineage(near), ["by", "column", "value"]))
        only = {(r["by"], r["column"]) for r in proofs.where("not proven").collect()}   # one row a snapshot and column
        columns = [c for c in columns if c in {c for _, c in only}]
        counters *= GROWTH
        if not only:
            break
    if only:
        left = df.sparkSession.createDataFrame(sorted(only), "by string, column string")
        parts.append(_counted(df, columns, by, left, ["by", "column"]))
    top = top_values(reduce(DataFrame.unionByName, parts), k, "by")
    key = F.when(F.col("by") != "null", F.substring("by", 2, 1 << 30).try_cast(df.schema[by].dataType))
    return top.select(key.alias(by), "column", "value", "n", "rank")
