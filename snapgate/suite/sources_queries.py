"""Scans, discovery, metric history and layer round trips."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from snapgate.functions.text import na_to_null, snapshot_of_path
from snapgate.operators import profile as pf
from snapgate.sinks.layers import append_metrics, write_layer
from snapgate.sinks.scratch import cut_lineage, scratch_dir
from snapgate.sources import metrics as mt, snapshots as sn
from snapgate.sources.raw import CORRUPT, ORDER_COLUMNS, read_layer, read_raw, stamp, with_source_order
from snapgate.suite.inputs import (CALENDAR, CLEAN, CONTRACT, SNAP, SNAP_KEYS, calendar, out, snap,
                                   table)
from snapgate.operators import cleaning

RUN_TS = "2024-02-01 00:00:00"
_BRONZE = ["src_pos", "snapshot_date", "entity_id", "category", "period", "amount", "measure_text"]


def _silver(spark, sf):
    return cleaning.clean(snap(spark, sf), CONTRACT, SNAP_KEYS, ["src_pos"])


def raw_csv_scan(spark, sf):
    """Write the snapshots as raw CSV, scan them as text and order them as in the files."""
    path = scratch_dir(spark)
    write_layer(snap(spark, sf).select(*_BRONZE), path, "csv")
    raw = read_raw(spark, path)
    return out(raw.select("snapshot_date", *[c for c in _BRONZE if c != "snapshot_date"]))


def raw_csv_corrupt_rows(spark, sf):
    """Raw lines with one cell too many, which a keeping read sets aside with their text."""
    path = scratch_dir(spark)
    line = F.expr("concat(src_pos, ',', category, if(src_pos % 211 = 0, ',x', ''))").alias("src_pos,category")
    rows = snap(spark, sf).select("snapshot_date", line)
    rows.write.partitionBy("snapshot_date").option("header", True).option("sep", "\u0001").csv(path)
    raw = read_raw(spark, path, on_corrupt="keep")
    return out(raw.where(F.col(CORRUPT).isNotNull()).select("snapshot_date", "src_pos", "category", F.col(CORRUPT).alias("line")))


def raw_csv_quoted_breaks(spark, sf):
    """Raw files whose cells hold line breaks, quotes and commas, read by many tasks."""
    path = scratch_dir(spark)
    note = F.expr("""concat(category, case src_pos % 3 when 0 then concat('\\n"', period, '",\\r\\n\\n', src_pos, '.')
                                                      when 1 then concat(' 5" ', period, ', x') else '' end)""").alias("note")
    rows = snap(spark, sf).select("snapshot_date", "src_pos", note, "period")
    write_layer(rows, path, "csv")
    raw = read_raw(spark, path, multi_line=True)
    return out(raw.select("snapshot_date", "src_pos", "note", "period"))


def silver_schema_growth(spark, sf):
    """A layer of which only the odd days have the column ``note``, read whole, by list and by day."""
    path, days = scratch_dir(spark), snap(spark, sf).select("snapshot_date", "src_pos", "period")
    odd = F.dayofmonth("snapshot_date") % 2 == 1
    write_layer(days.where(odd).select("snapshot_date", "src_pos", F.col("period").alias("note")), path)
    write_layer(days.where(~odd).select("snapshot_date", "src_pos"), path)
    listed = ["2024-01-02", "2024-01-03"]
    parts = [("whole", None), ("listed", listed), *(("single", [d]) for d in listed)]
    counted = []
    for how, which in parts:
        rows = read_layer(spark, path, snapshots=which)
        note = F.col("note") if "note" in rows.columns else F.lit(None).cast("string")
        counted.append(rows.groupBy("snapshot_date").agg(F.count("*").alias("row_count"), F.count(note).alias("notes"))
                       .select(F.lit(how).alias("how"), "*"))
    return out(reduce(lambda a, b: a.unionByName(b), counted))


def na_token_nulls(spark, sf):
    s = snap(spark, sf).withColumn("cell", na_to_null(F.col("measure_text")))
    return out(s.groupBy("snapshot_date").agg(
        F.count("*").alias("cells"), F.count("cell").alias("present"),
        F.count_if(F.col("cell").isNull()).alias("missing")))


def snapshot_discovery(spark, sf):
    return out(sn.discover_snapshots(snap(spark, sf)))


def latest_snapshot_rows(spark, sf):
    return out(sn.rows_of_latest(snap(spark, sf)).groupBy("snapshot_date").agg(
        F.count("*").alias("row_count"), F.count("entity_id").alias("entities")))


def missing_snapshots(spark, sf):
    return out(sn.missing_snapshots(calendar(spark, sf), snap(spark, sf)))


def empty_snapshots(spark, sf):
    rows = cleaning.drop_null_critical(snap(spark, sf), CONTRACT.critical)
    return out(sn.empty_snapshots(calendar(spark, sf), rows))


def snapshot_row_count(spark, sf):
    return out(snap(spark, sf).groupBy("snapshot_date").agg(F.count("*").alias("row_count")))


def snapshot_path_parse(spark, sf):
    """The date taken back out of every row's partition path."""
    path = F.concat(F.lit("lake/raw/snapshot_date="), F.col("snapshot_date").cast("string"),
                    F.lit("/part-"), F.col("period"), F.lit(".csv"))
    return (snap(spark, sf).select(snapshot_of_path(path).alias("snapshot"), "period")
            .groupBy("snapshot", "period").agg(F.count("*").alias("row_count")))


def json_metric_scan(spark, sf):
    e = table(spark, sf, "events").select(
        F.col("ts").cast("date").alias("snapshot_date"),
        F.from_json("props", "k bigint")["k"].alias("k"))
    return out(e.groupBy("snapshot_date").agg(
        F.count("k").alias("records"), F.sum("k").alias("k_sum"), F.max("k").alias("k_max")))


def _run_records(spark, sf):
    """Metric records per category, snapshot and run (a quarter day counts as one run)."""
    return (snap(spark, sf).groupBy(F.col("category").alias("dataset"), "snapshot_date",
                                    F.substring("period", 2, 1).cast("bigint").alias("run_seq"))
            .agg(F.count("*").alias("row_count")))


def latest_metric_record(spark, sf):
    return out(mt.latest_record(_run_records(spark, sf), ["dataset"], ["snapshot_date", "run_seq"]))


def metric_history_compacted(spark, sf):
    """Records of many runs in as many files, compacted and then added to: the newest of each category and day."""
    path = scratch_dir(spark)
    runs = _run_records(spark, sf).drop("run_seq").groupBy("dataset", "snapshot_date").agg(F.sum("row_count").alias("row_count"))
    counts = cut_lineage(runs).coalesce(1)
    for seq in (1, 2, 3):
        append_metrics(counts.withColumn("row_count", F.col("row_count") * seq).where(F.dayofmonth("snapshot_date") % seq == 0), path, seq, RUN_TS)
        mt.compact_metrics(spark, path, limit=seq - 1)
    history = mt.read_metrics(spark, path, "snapshot_date string, dataset string, row_count bigint, run_seq bigint")
    return mt.latest_record(history, ["dataset", "snapshot_date"], ["run_seq"])


def metric_history_union(spark, sf):
    """Two runs append their records as JSON lines; both stay in the history."""
    path = scratch_dir(spark)
    counts = pf.value_counts(snap(spark, sf), ["category", "period"])
    append_metrics(counts, path, 1, RUN_TS)
    append_metrics(counts.where("column = 'period'"), path, 2, RUN_TS)
    history = mt.read_metrics(
        spark, path, "snapshot_date string, column string, value string, n bigint, run_seq bigint")
    return history


def bronze_stamp(spark, sf):
    return out(stamp(snap(spark, sf).select(*_BRONZE), RUN_TS))


def bronze_roundtrip(spark, sf):
    path = scratch_dir(spark)
    write_layer(stamp(snap(spark, sf).select(*_BRONZE), RUN_TS), path)
    return out(read_layer(spark, path).select(*_BRONZE, "ingested_at"))


def bronze_csv_roundtrip(spark, sf):
    path = scratch_dir(spark)
    write_layer(stamp(snap(spark, sf).select(*_BRONZE), RUN_TS), path, "csv")
    back = read_layer(spark, path, "csv")
    return out(back.select(
        F.col("src_pos").cast("bigint").alias("src_pos"), "snapshot_date",
        F.col("entity_id").cast("bigint").alias("entity_id"), "category", "period",
        F.col("amount").cast("bigint").alias("amount"), "measure_text",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at")))


_SILVER = ["src_pos", "snapshot_date", "entity_id", "category", "period", "measure"]


def silver_roundtrip(spark, sf):
    path = scratch_dir(spark)
    write_layer(_silver(spark, sf).select(*_SILVER), path, rebalance=True)
    return out(read_layer(spark, path).select(*_SILVER))


def silver_csv_roundtrip(spark, sf):
    path = scratch_dir(spark)
    write_layer(_silver(spark, sf).select(*_SILVER), path, "csv", rebalance=True)
    back = read_layer(spark, path, "csv")
    return out(back.select(*[
        F.col(c).cast("bigint").alias(c) if c in ("src_pos", "entity_id", "measure") else c
        for c in _SILVER]))


def source_order_dedup(spark, sf):
    """Keep-first with the order taken from the files: the position of a row in its file."""
    e = with_source_order(table(spark, sf, "orders"), "parquet")
    first = cleaning.keep_first(
        e.withColumn("snapshot_year", F.year("o_orderdate")), ["o_custkey", "snapshot_year"],
        [F.col(c).asc() for c in ORDER_COLUMNS])
    return first.select("o_custkey", "snapshot_year", "o_orderkey")


_BRONZE_SQL = """src_pos, cast(snapshot_date as varchar) as snapshot_date, entity_id, category, period,
       amount, measure_text"""

QUERIES = {
    "raw_csv_scan_rows": (raw_csv_scan, f"""with {SNAP}
select cast(src_pos as varchar) as src_pos, cast(snapshot_date as varchar) as snapshot_date,
       cast(entity_id as varchar) as entity_id, category, period,
       cast(amount as varchar) as amount, nullif(measure_text, 'NA') as measure_text from snap"""),
    "raw_csv_corrupt_rows": (raw_csv_corrupt_rows, f"""with {SNAP}
select cast(snapshot_date as varchar) as snapshot_date, cast(src_pos as varchar) as src_pos,
       category, concat(src_pos, ',', category, ',x') as line
from snap where src_pos % 211 = 0"""),
    "raw_csv_quoted_breaks": (raw_csv_quoted_breaks, f"""with {SNAP}
select cast(snapshot_date as varchar) as snapshot_date, cast(src_pos as varchar) as src_pos,
       category || case src_pos % 3 when 0 then concat(chr(10), '"', period, '",', chr(13), chr(10), chr(10), src_pos, '.')
                                    when 1 then concat(' 5" ', period, ', x') else '' end as note,
       period from snap"""),
    "silver_schema_growth": (silver_schema_growth, f"""with {SNAP},
d as (select cast(snapshot_date as varchar) as snapshot_date, count(*) as row_count,
             count(*) filter (day(snapshot_date) % 2 = 1) as notes from snap group by 1)
select 'whole' as how, * from d
union all select how, d.* from d, (values ('listed'), ('single')) as h(how)
where snapshot_date in ('2024-01-02', '2024-01-03')"""),
    "na_token_nulls": (na_token_nulls, f"""with {SNAP}
select cast(snapshot_date as varchar) as snapshot_date, count(*) as cells,
       count(nullif(measure_text, 'NA')) as present,
       count(*) - count(nullif(measure_text, 'NA')) as missing from snap group by 1"""),
    "snapshot_discovery": (snapshot_discovery,
        "select distinct cast(cast(ts as date) as varchar) as snapshot_date from events"),
    "latest_snapshot_rows_count": (latest_snapshot_rows, f"""with {SNAP}
select cast(snapshot_date as varchar) as snapshot_date, count(*) as row_count,
       count(entity_id) as entities from snap
where snapshot_date = (select max(snapshot_date) from snap) group by 1"""),
    "missing_snapshots": (missing_snapshots, f"""with {SNAP}, {CALENDAR}
select cast(snapshot_date as varchar) as snapshot_date from calendar
where snapshot_date not in (select snapshot_date from snap)"""),
    "empty_snapshots": (empty_snapshots, f"""with {SNAP}, {CALENDAR}, {CLEAN}
select cast(c.snapshot_date as varchar) as snapshot_date, count(f.src_pos) as row_count
from calendar c left join firsts f using (snapshot_date) group by 1 having count(f.src_pos) = 0"""),
    "snapshot_row_count": (snapshot_row_count, f"""with {SNAP}
select cast(snapshot_date as varchar) as snapshot_date, count(*) as row_count from snap group by 1"""),
    "snapshot_path_parse": (snapshot_path_parse, f"""with {SNAP}
select cast(snapshot_date as varchar) as snapshot, period, count(*) as row_count from snap group by all"""),
    "json_metric_scan": (json_metric_scan, """
select cast(cast(ts as date) as varchar) as snapshot_date, count(props->>'$.k') as records,
       cast(sum(cast(props->>'$.k' as bigint)) as bigint) as k_sum,
       max(cast(props->>'$.k' as bigint)) as k_max from events group by 1"""),
    "latest_metric_record": (latest_metric_record, f"""with {SNAP},
r as (select category as dataset, snapshot_date, cast(substr(period, 2) as bigint) as run_seq,
             count(*) as row_count from snap group by all)
select dataset, cast(snapshot_date as varchar) as snapshot_date, run_seq, row_count from (
  select *, row_number() over (partition by dataset order by snapshot_date desc, run_seq desc) as rn
  from r) where rn = 1"""),
    "metric_history_compacted": (metric_history_compacted, f"""with {SNAP},
c as (select category as dataset, snapshot_date, count(*) as row_count from snap group by all),
r as (select *, case when day(snapshot_date) % 3 = 0 then 3 when day(snapshot_date) % 2 = 0 then 2 else 1 end as run_seq from c)
select dataset, cast(snapshot_date as varchar) as snapshot_date, row_count * run_seq as row_count, run_seq from r"""),
    "metric_history_union": (metric_history_union, f"""with {SNAP},
c as (select snapshot_date, 'category' as "column", category as value, count(*) as n from snap group by all
      union all
      select snapshot_date, 'period', period, count(*) from snap group by all)
select cast(snapshot_date as varchar) as snapshot_date, "column", value, n, 1 as run_seq from c
union all
select cast(snapshot_date as varchar), "column", value, n, 2 from c where "column" = 'period'"""),
    "bronze_stamp": (bronze_stamp, f"""with {SNAP}
select {_BRONZE_SQL}, '{RUN_TS}' as ingested_at from snap"""),
    "bronze_roundtrip": (bronze_roundtrip, f"""with {SNAP}
select {_BRONZE_SQL}, '{RUN_TS}' as ingested_at from snap"""),
    "bronze_csv_roundtrip_rows": (bronze_csv_roundtrip, f"""with {SNAP}
select * replace (nullif(measure_text, 'NA') as measure_text) from (
  select {_BRONZE_SQL}, '{RUN_TS}' as ingested_at from snap)"""),
    "silver_roundtrip": (silver_roundtrip, f"""with {SNAP}, {CLEAN}
select src_pos, cast(snapshot_date as varchar) as snapshot_date, entity_id, category, period,
       cast(trunc(measure) as bigint) as measure from firsts"""),
    "silver_csv_roundtrip_rows": (silver_csv_roundtrip, f"""with {SNAP}, {CLEAN}
select src_pos, cast(snapshot_date as varchar) as snapshot_date, entity_id, category, period,
       cast(trunc(measure) as bigint) as measure from firsts"""),
    "source_order_dedup": (source_order_dedup, """
select o_custkey, snapshot_year, o_orderkey from (
  select o_custkey, cast(year(o_orderdate) as int) as snapshot_year, o_orderkey,
         row_number() over (partition by o_custkey, year(o_orderdate) order by o_orderkey) as rn
  from orders) where rn = 1"""),
}
