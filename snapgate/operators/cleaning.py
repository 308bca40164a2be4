"""Silver cleaning: null drop, ordered deduplication, typed columns, row accounting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from snapgate.config import CONTRACT_TYPES, Contract
from snapgate.functions.text import is_missing, not_convertible, strict


def any_missing(df: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [is_missing(df, c) for c in columns], F.lit(False))


def drop_null_critical(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with NULL or NaN in any of ``columns``; the conditions reach the scan."""
    for c in columns:
        df = df.where(~is_missing(df, c))
    return df


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``.

    ``row_number() = 1`` plans a group limit ahead of the shuffle, so each task sends at
    most one row per key and a key with very many copies never meets in one task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(first))
            .where("_rn = 1").drop("_rn"))


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last in ``order``, as if the rows were applied one by one."""
    return keep_first(df, keys, [F.col(c).desc() for c in order])


def enforce_types(df: DataFrame, contract: Contract) -> DataFrame:
    """Cast integer and date columns; a present value that does not convert fails the job."""
    return df.withColumns({
        c.name: strict(df, c.name, c.type, CONTRACT_TYPES[c.type])
        for c in contract.columns if c.type != "string" and c.name in df.columns
    })


def _bad_values(df: DataFrame, contract: Contract) -> dict[str, Column]:
    return {c.name: not_convertible(F.col(c.name), df.schema[c.name].dataType, c.type)
            for c in contract.columns
            if c.type != "string" and c.name in df.columns
            and df.schema[c.name].dataType != CONTRACT_TYPES[c.type]}


def cast_rejects(df: DataFrame, contract: Contract) -> DataFrame:
    """The rows :func:`enforce_types` would fail on; ``_rejects`` names the columns."""
    bad = _bad_values(df, contract)
    names = [F.when(cond, F.array(F.lit(name))).otherwise(F.array()) for name, cond in bad.items()]
    reasons = F.concat(*names) if names else F.array().cast("array<string>")
    return df.where(reduce(lambda a, b: a | b, bad.values(), F.lit(False))).withColumn("_rejects", reasons)


def drop_rejects(df: DataFrame, contract: Contract) -> DataFrame:
    """The other rows."""
    for cond in _bad_values(df, contract).values():
        df = df.where(~cond)
    return df


def clean(df: DataFrame, contract: Contract, keys: Sequence[str],
          order: Sequence[str], on_bad_cast: str = "fail") -> DataFrame:
    """Null drop, keep-first dedup, typed casts: Bronze rows to Silver rows.

    ``on_bad_cast='fail'`` fails the job on a value that does not convert; ``'drop'``
    leaves such rows out ahead of the dedup, for callers that store :func:`cast_rejects` beside
    the result: a good row never gives way to a refused one of the same key.
    """
    absent = [c for c in contract.critical if c not in df.columns]
    if absent:
        raise ValueError(f"missing critical columns: {absent}")
    kept = drop_null_critical(df, contract.critical)
    if on_bad_cast == "drop":
        kept = drop_rejects(kept, contract)
    return enforce_types(keep_first(kept, keys, [F.col(c).asc() for c in order]), contract)


def row_accounting(df: DataFrame, critical: Sequence[str], keys: Sequence[str],
                   by: str = "snapshot_date", duplicates: bool = False) -> DataFrame:
    """Rows in, after the null drop and after dedup per snapshot, and the rows dropped.

    Counts are pre-aggregated per key, so only key counts are shuffled, never the rows.
    ``duplicates`` adds the duplicate report's ``duplicated_keys``, off the same counts.
    """
    bad = any_missing(df, critical)
    per_key = (df.select(by, *[F.when(~bad, F.col(k)).alias(f"_k{i}") for i, k in enumerate(keys)],
                         F.when(bad, 0).otherwise(1).alias("_ok"))
               .groupBy(by, "_ok", *[f"_k{i}" for i in range(len(keys))])
               .agg(F.count("*").alias("_n")))
    total = per_key.groupBy(by).agg(
        F.sum("_n").alias("rows_in"),
        F.sum(F.col("_n") * F.col("_ok")).alias("rows_after_nulls"),
        F.sum(F.col("_ok").cast("bigint")).alias("rows_after_dedup"),
        F.count_if((F.col("_ok") == 1) & (F.col("_n") > 1)).alias("duplicated_keys"),
    )
    report = ["duplicated_keys"] if duplicates else []
    return total.select(
        by, "rows_in", "rows_after_nulls", "rows_after_dedup",
        (F.col("rows_in") - F.col("rows_after_nulls")).alias("dropped_nulls"),
        (F.col("rows_after_nulls") - F.col("rows_after_dedup")).alias("dropped_duplicates"), *report,
    )


def duplicate_counts(df: DataFrame, keys: Sequence[str], by: str = "snapshot_date") -> DataFrame:
    """Surplus rows per snapshot: what keep-first dedup on ``keys`` will drop."""
    groups = list(dict.fromkeys([by, *keys]))
    per_key = df.groupBy(*groups).agg(F.count("*").alias("_n"))
    return per_key.groupBy(by).agg(
        F.sum(F.col("_n") - 1).alias("duplicate_rows"),
        F.sum(F.when(F.col("_n") > 1, 1).otherwise(0)).cast("bigint").alias("duplicated_keys"),
    )


def new_keys(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key ``known`` does not have; keys with NULLs are keys like any other."""
    there = known.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return rows.join(there, same, "left_anti")
