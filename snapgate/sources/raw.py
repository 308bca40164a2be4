"""Raw, Bronze and Silver scans."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from snapgate.functions.text import na_to_null_all
from snapgate.sources.quoted import read_records
from snapgate.sources.snapshots import snapshot_paths

SNAPSHOT = "snapshot_date"

# Lineage columns that fix the order of source rows once and for all.
ORDER_COLUMNS = ["_src_file", "_src_block", "_src_pos"]

CORRUPT = "_corrupt_record"
# without pruning a line's cells are counted whichever columns are wanted
CSV_OPTIONS = {"header": True, "escape": '"', "enforceSchema": False, "columnNameOfCorruptRecord": CORRUPT, "columnPruning": False}


def _csv_schema(spark: SparkSession, paths: Sequence[str], base: str, multi_line: bool) -> T.StructType:
    """All header columns as text; only the first file's header is read."""
    head = spark.read.options(header=True, escape='"', basePath=base, multiLine=multi_line).csv(list(paths))
    names = [f.name for f in head.schema.fields if f.name != SNAPSHOT]
    partitioned = SNAPSHOT in head.columns
    return T.StructType([T.StructField(n, T.StringType()) for n in names]
                        + ([T.StructField(SNAPSHOT, T.StringType())] if partitioned else []))


def _wider(text, cells: Sequence[str]):
    """The cells of a CSV line as a struct, with a field for one cell too many."""
    fields = ", ".join([*(f"`c{i}` string" for i in range(len(cells))), "`beyond` string"])
    return F.from_csv(text, fields, {"escape": '"', "mode": "PERMISSIVE"})


def _refuse(bad: Column, message: str, text: Column) -> Column:
    """A condition that fails the read where ``bad`` holds; as a filter it outlives every projection."""
    return F.when(bad, F.raise_error(F.concat(F.lit(message), text)).cast("boolean")).otherwise(F.lit(True))


TOO_MANY = "line with too many cells: "


def _csv(spark: SparkSession, root: str, snapshots: Sequence[str] | None, on_corrupt: str = "fail",
         files: Sequence[str] | None = None) -> DataFrame:
    """All cells as text. A line with more cells than the header fails the read, with its text.

    With ``on_corrupt='keep'`` such lines stay and their text is in the column ``_corrupt_record``,
    NULL for the other lines. Either holds whichever columns are read. A line with fewer cells has
    NULLs at its end.
    """
    paths = files or snapshot_paths(root, snapshots)
    schema = _csv_schema(spark, paths, root, False)
    cells = [f.name for f in schema.fields if f.name != SNAPSHOT]
    read = spark.read.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
    df = read.options(**CSV_OPTIONS, basePath=root).csv(paths)
    # Spark refuses to read the text of bad lines alone, so a cell takes part; its condition always holds
    with_cell = F.coalesce(F.length(cells[0]) >= 0, F.lit(True))
    too_many = with_cell & F.col(CORRUPT).isNotNull() & _wider(F.col(CORRUPT), cells)["beyond"].isNotNull()
    if on_corrupt == "keep":
        return df.withColumn(CORRUPT, F.when(too_many, F.col(CORRUPT)))
    return df.where(_refuse(too_many, TOO_MANY, F.col(CORRUPT))).drop(CORRUPT)


def _quoted_csv(spark: SparkSession, root: str, snapshots: Sequence[str] | None, on_corrupt: str = "fail",
                files: Sequence[str] | None = None, order: bool = False) -> DataFrame:
    """:func:`_csv` where quoted cells may hold line breaks; files are split. ``order`` adds the source order."""
    paths = files or snapshot_paths(root, snapshots)
    schema = _csv_schema(spark, paths, root, True)
    names = [f.name for f in schema.fields if f.name != SNAPSHOT]
    by = SNAPSHOT if SNAPSHOT in schema.names else None
    rows = read_records(spark, paths, root, by).withColumn("cells", _wider(F.col("text"), names))
    # Spark numbers header cells that are empty or repeated
    known = [(F.lower(F.coalesce(F.col(f"cells.c{i}"), F.lit("_c"))).isin(n.lower(), n.lower().removesuffix(str(i)))) for i, n in enumerate(names)]
    other = F.col("head") & ~(reduce(lambda a, b: a & b, known) & F.col("cells.beyond").isNull())
    rows = rows.where(_refuse(other, "header differs from the first file's: ", F.col("text"))).where(~F.col("head"))
    too_many = F.col("cells.beyond").isNotNull()
    kept = F.when(too_many, F.col("text")).alias(CORRUPT)
    if on_corrupt != "keep":
        rows = rows.where(_refuse(too_many, TOO_MANY, F.col("text")))
    place = [F.col(c).alias(n) for c, n in zip(("file", "block", "pos"), ORDER_COLUMNS)] if order else []
    return rows.select(*(F.col(f"cells.c{i}").alias(n) for i, n in enumerate(names)), *([F.col("snapshot").alias(by)] if by else []),
                       *([kept] if on_corrupt == "keep" else []), *place)


def read_csv_text(spark: SparkSession, root: str, snapshots: Sequence[str] | None = None, multi_line: bool = False) -> DataFrame:
    """CSV with a header, every cell as text, missing-value tokens as NULL.

    Values stay text so that digits in a string column remain a string. A file whose header
    differs from the first one's fails the read instead of being mapped by position.
    """
    return na_to_null_all((_quoted_csv if multi_line else _csv)(spark, root, snapshots))


def read_parquet(spark: SparkSession, root: str, snapshots: Sequence[str] | None = None,
                 files: Sequence[str] | None = None) -> DataFrame:
    """Parquet snapshots with a text ``snapshot_date``.

    Schemas are always merged, so that a column only some snapshots have is there however
    they are asked for.
    """
    df = spark.read.options(basePath=root, mergeSchema=True).parquet(*(files or snapshot_paths(root, snapshots)))
    return df.withColumn(SNAPSHOT, F.col(SNAPSHOT).cast("string"))


def with_source_order(df: DataFrame, file_format: str) -> DataFrame:
    """Add the columns that order rows as they lie in the source files.

    Parquet rows carry their index in the file. CSV rows do not: there the order is file,
    then split offset, then the id, which increases within a split.
    """
    if file_format == "parquet":
        block, pos = F.lit(0).cast("bigint"), F.col("_metadata.row_index")
    else:
        block, pos = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    return df.withColumns({"_src_file": F.col("_metadata.file_path"),
                           "_src_block": block, "_src_pos": pos})


def read_raw(spark: SparkSession, root: str, file_format: str = "csv",
             snapshots: Sequence[str] | None = None, multi_line: bool = False,
             on_corrupt: str = "fail", files: Sequence[str] | None = None) -> DataFrame:
    """The raw layer with its source order; only the given snapshots, or files of it, are listed and read.

    ``multi_line`` reads quoted line breaks as part of a cell, at the price of a second pass over
    the files (:mod:`snapgate.sources.quoted`).
    """
    if file_format == "csv" and multi_line:
        return na_to_null_all(_quoted_csv(spark, root, snapshots, on_corrupt, files, order=True))
    if file_format == "csv":
        return na_to_null_all(with_source_order(_csv(spark, root, snapshots, on_corrupt, files), "csv"))
    return with_source_order(read_parquet(spark, root, snapshots, files), "parquet")


def read_layer(spark: SparkSession, root: str, file_format: str = "parquet",
               snapshots: Sequence[str] | None = None, multi_line: bool = False) -> DataFrame:
    """Bronze or Silver; only the given snapshots are listed and read."""
    if file_format == "csv":
        return read_csv_text(spark, root, snapshots, multi_line)
    return read_parquet(spark, root, snapshots)


def stamp(df: DataFrame, run_ts: str) -> DataFrame:
    """Add ``ingested_at``: one literal per run, so a repeated run gives the same rows."""
    return df.withColumn("ingested_at", F.lit(run_ts).cast("timestamp_ntz"))
