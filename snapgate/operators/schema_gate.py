"""Schema gate on the data itself: presence, types, castability, nulls, scorecard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapgate.config import CONTRACT_TYPES, Contract
from snapgate.functions.text import is_missing, try_date
from snapgate.sources.snapshots import cover


def actual_columns(spark: SparkSession, df: DataFrame, dataset: str) -> DataFrame:
    """``(dataset, name, type)`` of a DataFrame's columns, types in contract terms."""
    known = {t: name for name, t in CONTRACT_TYPES.items()}
    rows = [(dataset, f.name, known.get(f.dataType, f.dataType.simpleString()))
            for f in df.schema.fields]
    return spark.createDataFrame(rows, "dataset string, name string, type string")


def missing_columns(contract: DataFrame, actual: DataFrame,
                    on: Sequence[str] = ("dataset", "name")) -> DataFrame:
    """Contract columns the data does not have. Any row fails the gate."""
    return contract.join(actual, list(on), "left_anti")


def extra_columns(contract: DataFrame, actual: DataFrame,
                  on: Sequence[str] = ("dataset", "name")) -> DataFrame:
    """Columns beyond the contract; allowed, worth a warning."""
    return actual.join(contract, list(on), "left_anti")


def type_mismatches(contract: DataFrame, actual: DataFrame,
                    on: Sequence[str] = ("dataset", "name")) -> DataFrame:
    """Columns whose type differs from the contract's; all of them, not just the first."""
    want = contract.select(*on, F.col("type").alias("expected_type"))
    have = actual.withColumnRenamed("type", "actual_type")
    return want.join(have, list(on)).where("expected_type <> actual_type")


def _not_castable(df: DataFrame, name: str, contract_type: str):
    col, dtype = F.col(name), df.schema[name].dataType
    if contract_type == "string":
        return F.lit(False) if isinstance(dtype, T.StringType) else col.isNotNull()
    if contract_type == "integer" and isinstance(dtype, T.StringType):
        ok = col.try_cast("bigint").isNotNull()
    elif contract_type == "integer":
        return F.lit(False) if isinstance(dtype, T.IntegralType) else col.isNotNull()
    elif isinstance(dtype, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        ok = try_date(col, dtype).isNotNull()
    else:
        return col.isNotNull()
    return col.isNotNull() & ~ok


def _unpivot_counts(df: DataFrame, by: str, counts: dict, value: str) -> DataFrame:
    """One aggregate over the rows, then one output row per counted column."""
    counted = [F.count_if(cond).alias(f"c_{name}") for name, cond in counts.items()]
    agg = df.groupBy(by).agg(F.count("*").alias("_rows"), *counted)
    pairs = F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"c_{n}").alias(value))
                      for n in counts])
    return agg.select(by, F.col("_rows").alias("row_count"), F.inline(pairs))


def castability(df: DataFrame, contract: Contract, by: str = "snapshot_date") -> DataFrame:
    """Values per snapshot and column that do not convert to the contract type."""
    counts = {c.name: _not_castable(df, c.name, c.type)
              for c in contract.columns if c.name in df.columns}
    return _unpivot_counts(df, by, counts, "bad_values")


def null_counts(df: DataFrame, columns: Sequence[str], by: str = "snapshot_date") -> DataFrame:
    return _unpivot_counts(df, by, {c: is_missing(df, c) for c in columns if c in df.columns},
                           "null_values")


def null_violations(df: DataFrame, contract: Contract, by: str = "snapshot_date") -> DataFrame:
    """Required columns that hold a NULL or NaN, per snapshot."""
    return null_counts(df, contract.critical, by).where("null_values > 0")


def scorecard(df: DataFrame, contract: Contract, by: str = "snapshot_date",
              evolution_ok: bool = True, snapshots: DataFrame | None = None,
              strict_types: bool = False) -> DataFrame:
    """Four ordered checks per snapshot: evolution, presence, types, nulls.

    ``checks_passed`` counts the leading passes and ``checks_failed`` is 1 when one fails,
    all from a single aggregate over the rows; the offending columns of every check are named.
    ``evolution_ok`` is the contract gate's answer. With ``snapshots`` those without rows have
    a scorecard too. The type check asks whether the values convert, which is all that text
    layers can answer; with ``strict_types`` the column must have exactly the contract's type,
    but for ``by``, a folder name whose values are text in every layer.
    """
    present = [c for c in contract.columns if c.name in df.columns]
    missing = [c for c in contract.names if c not in df.columns]
    strict = [c for c in present if strict_types and c.name != by]
    wrong = [c.name for c in strict if df.schema[c.name].dataType != CONTRACT_TYPES[c.type]]
    types = {c.name: F.count_if(_not_castable(df, c.name, c.type)) for c in present if c not in strict}
    nulls = {c: F.count_if(is_missing(df, c)) for c in contract.critical if c in df.columns}
    agg = df.groupBy(by).agg(F.count("*").alias("row_count"),
                             *[n.alias(f"t_{c}") for c, n in types.items()],
                             *[n.alias(f"n_{c}") for c, n in nulls.items()])
    if snapshots is not None:
        agg = cover(snapshots, agg, [c for c in agg.columns if c != by], by)
    agg = agg.select(
        by, F.lit(contract.version).alias("schema_version"), "row_count",
        _names(F.lit(True), missing).alias("missing_columns"),
        F.concat(_names(F.lit(True), wrong), *[_names(F.col(f"t_{c}") > 0, [c]) for c in types])
        .alias("uncastable_columns"),
        F.concat(_names(F.lit(True), []), *[_names(F.col(f"n_{c}") > 0, [c]) for c in nulls])
        .alias("null_columns"))
    checks = [F.lit(evolution_ok), F.size("missing_columns") == 0, F.size("uncastable_columns") == 0,
              F.size("null_columns") == 0]
    passed = F.lit(len(checks))
    for i in reversed(range(len(checks))):
        passed = F.when(~checks[i], F.lit(i)).otherwise(passed)
    failed = F.col("checks_passed") < len(checks)
    return agg.withColumn("checks_passed", passed).withColumns({
        "checks_failed": F.when(failed, 1).otherwise(0),
        "status": F.when(failed, "FAILED").otherwise("PASSED"),
    })


def _names(cond, names: Sequence[str]):
    """The names as an array where the condition holds, else no names."""
    none = F.array().cast("array<string>")
    return F.when(cond, F.array(*[F.lit(n) for n in names]).cast("array<string>")).otherwise(none)
