"""Skewed tables (a third of the rows on one day, user, customer and order) against SQL."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from oracle import compare, connect  # noqa: E402
from snapgate.operators import cleaning  # noqa: E402
from snapgate.suite import catalog  # noqa: E402
from snapgate.suite.inputs import snap, table  # noqa: E402

SOURCE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("skewed"))

    def thrice(name):
        return table(spark, SOURCE, name).withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(2))))

    def hot(value, other):
        return F.when(F.col("copy") == 0, F.lit(value)).otherwise(other)

    def write(df, name):
        df.drop("copy").repartition(4).write.parquet(f"{out}/{name}.parquet")

    write(thrice("events").withColumns({
        "event_id": F.col("event_id") * 3 + F.col("copy"), "user_id": hot(7, F.col("user_id")).cast("bigint"),
        "ts": hot(None, F.col("ts"))}).withColumn(
            "ts", F.coalesce("ts", F.to_timestamp_ntz(F.lit("2024-01-15 10:00:00")))),
          "events")
    write(thrice("orders").withColumns({
        "o_orderkey": F.col("o_orderkey") * 3 + F.col("copy"),
        "o_custkey": hot(7, F.col("o_custkey")).cast("bigint")}), "orders")
    write(thrice("lineitem").withColumns({
        "l_orderkey": hot(7, F.col("l_orderkey")).cast("bigint"),
        "l_extendedprice": hot(4242.0, F.col("l_extendedprice") + F.col("copy"))}), "lineitem")
    write(table(spark, SOURCE, "part").withColumn("copy", F.lit(0)), "part")
    return out


@pytest.mark.parametrize("name", [
    "silver_clean", "silver_row_accounting", "dedup_dropped_count", "dedup_keep_first_lineitem",
    "profile_numeric", "profile_numeric_narrowing", "quantile_selection", "profile_top5",
    "profile_categorical", "drift_records", "dq_record", "schema_scorecard", "schema_missing_columns",
    "gold_upsert", "gold_upsert_stored", "gold_upsert_counts", "silver_roundtrip"])
def test_skewed_tables(spark, skewed, name):
    equal, message = compare(connect(skewed), catalog.queries()[name](spark, skewed), catalog.oracle_sql()[name])
    assert equal, message


def test_a_hot_key_sends_one_row_per_task(spark, skewed):
    """The shuffle behind keep-first carries at most one row of a key per input task."""
    rows = snap(spark, skewed).select("src_pos", F.lit(7).alias("k"), "category").withColumn(
        "k", F.col("k") + F.col("src_pos") * 0)
    first = cleaning.keep_first(rows, ["k"], [F.col("src_pos")])
    assert first.collect()[0]["src_pos"] == 0
    plan = first._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below
