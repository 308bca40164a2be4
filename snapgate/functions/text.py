"""Missing-value tokens, typed casts of text, and names that carry a date or version."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The cell texts a CSV reader with default settings treats as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]

NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def na_to_null(col: Column) -> Column:
    return F.when(~col.isin(NA_TOKENS), col)


def na_to_null_all(df: DataFrame) -> DataFrame:
    """Apply :func:`na_to_null` to every string column."""
    return df.withColumns({
        f.name: na_to_null(F.col(f.name))
        for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    })


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN in a floating column (NaN counts as missing everywhere)."""
    return ~_present(F.col(name), df.schema[name].dataType)


def nan_to_null(df: DataFrame, name: str) -> Column:
    return F.when(~is_missing(df, name), F.col(name))


def try_integer(col: Column, dtype: T.DataType) -> Column:
    """Value as bigint, truncated toward zero; NULL when it is not a finite number."""
    if not isinstance(dtype, T.StringType):
        return col.try_cast("bigint")
    number = F.when(col.rlike(NUMBER_TEXT), col.try_cast("double").try_cast("bigint"))
    return F.coalesce(col.try_cast("bigint"), number)


def try_date(col: Column, dtype: T.DataType) -> Column:
    return col.try_cast("date")


def try_typed(col: Column, dtype: T.DataType, contract_type: str) -> Column:
    """``col`` as a contract type, NULL where the value does not convert."""
    if contract_type == "integer":
        return try_integer(col, dtype)
    if contract_type == "date":
        return try_date(col, dtype)
    return col.cast("string")


def _present(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.isNotNull() & ~F.isnan(col)
    return col.isNotNull()


def not_convertible(col: Column, dtype: T.DataType, contract_type: str) -> Column:
    """A present value that :func:`try_typed` turns into NULL."""
    return _present(col, dtype) & try_typed(col, dtype, contract_type).isNull()


def strict(df: DataFrame, name: str, contract_type: str, target: T.DataType) -> Column:
    """The column in its contract type; the job fails on a present value that does not convert."""
    col, dtype = F.col(name), df.schema[name].dataType
    if dtype == target:
        return col
    typed = try_typed(col, dtype, contract_type)
    problem = F.concat(F.lit(f"{name}: cannot convert "), col.cast("string"))
    return F.when(_present(col, dtype), F.coalesce(typed, F.raise_error(problem)))


def snapshot_of_path(path: Column) -> Column:
    """The date text of a ``snapshot_date=YYYY-MM-DD`` path segment."""
    return F.regexp_extract(path, r"(?:^|/)snapshot_date=([^/]+)", 1)


def version_number(version: Column) -> Column:
    """``v12``, ``schema_v12`` or ``schema_v12.yaml`` -> 12, so that v10 sorts after v9."""
    return F.regexp_extract(version, r"v([0-9]+)", 1).cast("int")


def next_version(version: Column) -> Column:
    return F.concat(F.lit("v"), (version_number(version) + 1).cast("string"))
