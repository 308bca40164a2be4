"""Null drop, ordered dedup, casts: hand-built edge cases."""

import pytest
from pyspark.sql import functions as F, types as T

from snapgate.config import Contract, ContractColumn
from snapgate.functions.text import NA_TOKENS, na_to_null, next_version, snapshot_of_path, version_number
from snapgate.operators import cleaning as c
from snapgate.sources.raw import ORDER_COLUMNS, read_csv_text, read_raw, with_source_order

CONTRACT = Contract("v1", (
    ContractColumn("id", "integer", False), ContractColumn("name", "string", False),
    ContractColumn("points", "integer"), ContractColumn("day", "date")))


def values(df, *cols):
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=repr)


def test_null_drop_counts_nan_as_missing(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (3, None)], "id int, x double")
    assert values(c.drop_null_critical(df, ["x"]), "id") == [(1,)]
    assert c.drop_null_critical(df, []).count() == 3


def test_keep_first_and_last_are_idempotent(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("b", 5, "z")], "k string, o int, v string")
    first = c.keep_first(df, ["k"], [F.col("o")])
    assert values(first, "k", "v") == [("a", "x"), ("b", "z")]
    assert values(c.keep_first(first, ["k"], [F.col("o")]), "k", "v") == values(first, "k", "v")
    assert values(c.keep_last(df, ["k"], ["o"]), "k", "v") == [("a", "y"), ("b", "z")]


def test_keep_first_limits_groups_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    plan = c.keep_first(df, ["k"], [F.col("o")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_file_order_survives_many_files_and_splits(spark, tmp_path):
    path = str(tmp_path / "csv")
    (spark.range(0, 4000, 1, 4).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"),
                                       F.lit("x" * 40).alias("pad"))
     .write.option("header", True).csv(path))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        df = with_source_order(spark.read.option("header", True).schema("k int, v int, pad string").csv(path),
                               "csv")
        assert df.rdd.getNumPartitions() > 8
        got = values(c.keep_first(df, ["k"], [F.col(x) for x in ORDER_COLUMNS]), "k", "v")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    # files are named in the order of their rows, so the first 50 ids are the first of each key
    assert got == sorted([(i, i) for i in range(50)], key=repr)


def test_parquet_order_uses_row_index(spark, tmp_path):
    path = str(tmp_path / "pq")
    spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int").coalesce(1).write.parquet(path)
    df = with_source_order(spark.read.parquet(path), "parquet")
    assert values(c.keep_first(df, ["k"], [F.col(x) for x in ORDER_COLUMNS]), "k", "v") == [("a", 1), ("b", 3)]


def test_casts_truncate_and_fail_on_malformed_text(spark):
    df = spark.createDataFrame([("1", "a", "12.9", "2024-01-01"), ("2", "b", "-12.9", None),
                                ("3", "c", None, "2024-02-29")],
                               "id string, name string, points string, day string")
    typed = c.enforce_types(df, CONTRACT)
    assert typed.schema["points"].dataType == T.LongType() and typed.schema["day"].dataType == T.DateType()
    assert [r[0] for r in typed.orderBy("id").select("points").collect()] == [12, -12, None]
    bad = df.withColumn("points", F.lit("abc"))
    with pytest.raises(Exception, match="points: cannot convert abc"):
        c.enforce_types(bad, CONTRACT).collect()
    with pytest.raises(Exception, match="day: cannot convert"):
        c.enforce_types(df.withColumn("day", F.lit("2024-02-30")), CONTRACT).collect()


@pytest.mark.parametrize("text,want", [
    ("7", 7), ("+7", 7), (" 7 ", 7), ("7.0", 7), ("1e3", 1000), (".9", 0), ("9223372036854775807", 2**63 - 1),
    ("abc", None), ("7d", None), ("1_000", None), ("0x10", None), ("inf", None), ("", None), ("1e400", None)])
def test_integer_text(spark, text, want):
    from snapgate.functions.text import try_integer
    got = spark.range(1).select(try_integer(F.lit(text), T.StringType())).first()[0]
    assert got == want


def test_integer_from_double_refuses_nan_and_infinity(spark):
    from snapgate.functions.text import try_integer
    df = spark.createDataFrame([(0, float("nan")), (1, float("inf")), (2, -3.9)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(try_integer(F.col("x"), T.DoubleType())).collect()]
    assert got == [None, None, -3]


def test_rejects_carry_all_reasons_and_split_the_rows(spark):
    df = spark.createDataFrame([("1", "a", "x", "nope"), ("2", "b", "3", "2024-01-01")],
                               "id string, name string, points string, day string")
    bad = c.cast_rejects(df, CONTRACT).collect()
    assert [(r["id"], r["_rejects"]) for r in bad] == [("1", ["points", "day"])]
    kept = c.clean(df, CONTRACT, ["id"], ["id"], on_bad_cast="drop")
    assert values(kept, "id") == [(2,)]


def test_clean_needs_its_critical_columns(spark):
    with pytest.raises(ValueError, match="name"):
        c.clean(spark.createDataFrame([(1,)], "id int"), CONTRACT, ["id"], ["id"])


def test_row_accounting_adds_up(spark):
    df = spark.createDataFrame(
        [("d1", 1, "a"), ("d1", 1, "a"), ("d1", 1, "b"), ("d1", None, "a"), ("d2", None, "a")],
        "snapshot_date string, id int, name string")
    got = values(c.row_accounting(df, ["id"], ["id", "name"]), "snapshot_date", "rows_in",
                 "rows_after_nulls", "rows_after_dedup", "dropped_nulls", "dropped_duplicates")
    assert got == [("d1", 4, 3, 2, 1, 1), ("d2", 1, 0, 0, 1, 0)]


def test_na_tokens(spark):
    cells = NA_TOKENS + ["-", "none", "Na", "0"]
    df = spark.createDataFrame([(x,) for x in cells], "x string").withColumn("y", na_to_null(F.col("x")))
    assert {r["x"] for r in df.where("y is not null").collect()} == {"-", "none", "Na", "0"}


def test_csv_cells_and_headers(spark, tmp_path):
    d = tmp_path / "raw" / "snapshot_date=2024-01-01"
    d.mkdir(parents=True)
    (d / "a.csv").write_text('id,code,note\n1,007,"say ""hi"", ok"\n2,NA,""\n3,-,n/a\n')
    rows = read_raw(spark, str(tmp_path / "raw")).orderBy("id").collect()
    assert [(r["id"], r["code"], r["note"], r["snapshot_date"]) for r in rows] == [
        ("1", "007", 'say "hi", ok', "2024-01-01"), ("2", None, None, "2024-01-01"),
        ("3", "-", None, "2024-01-01")]
    (d / "b.csv").write_text("code,id,note\nx,9,y\n")
    with pytest.raises(Exception):
        read_csv_text(spark, str(tmp_path / "raw")).collect()


def test_names(spark):
    row = spark.range(1).select(
        snapshot_of_path(F.lit("/lake/raw/snapshot_date=2024-01-02/x.csv")),
        snapshot_of_path(F.lit("snapshot_date=2024-01-03")), snapshot_of_path(F.lit("other/x")),
        version_number(F.lit("schema_v10.yaml")), next_version(F.lit("v9"))).first()
    assert list(row) == ["2024-01-02", "2024-01-03", "", 10, "v10"]
