"""Silver cleaning: null drop, dedup, casts, accounting."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapgate.config import Contract, ContractColumn
from snapgate.functions.text import na_to_null, try_date, try_integer
from snapgate.operators import cleaning
from snapgate.suite.inputs import (CLEAN, CONTRACT, SNAP, SNAP_KEYS, TEXT_CONTRACT, out, snap, table)

_ROWS = ["src_pos", "snapshot_date", "entity_id", "category", "period"]


def silver_clean(spark, sf):
    clean = cleaning.clean(snap(spark, sf), CONTRACT, SNAP_KEYS, ["src_pos"])
    return out(clean.select(*_ROWS, "measure"))


DROP_CONTRACT = Contract("v3", tuple(ContractColumn(n, t, False) for n, t in [
    ("entity_id", "integer"), ("category", "string"), ("period", "string"), ("measure_text", "integer")]))


def silver_clean_drop(spark, sf):
    """Silver and rejects in drop mode: refused rows go ahead of the dedup."""
    rows = snap(spark, sf).withColumn("measure_text", na_to_null(F.col("measure_text")))
    silver = cleaning.clean(rows, DROP_CONTRACT, SNAP_KEYS, ["src_pos"], on_bad_cast="drop")
    rejects = cleaning.cast_rejects(rows, DROP_CONTRACT)
    return silver.select(F.lit("silver").alias("kind"), "src_pos").unionByName(rejects.select(F.lit("reject").alias("kind"), "src_pos"))


def dropna_critical(spark, sf):
    return out(cleaning.drop_null_critical(snap(spark, sf), CONTRACT.critical).select(*_ROWS))


def silver_row_accounting(spark, sf):
    return out(cleaning.row_accounting(snap(spark, sf), CONTRACT.critical, SNAP_KEYS))


def dedup_keep_first(spark, sf):
    rows = cleaning.drop_null_critical(snap(spark, sf), CONTRACT.critical)
    return out(cleaning.keep_first(rows, SNAP_KEYS, [F.col("src_pos")]).select(*_ROWS))


def dedup_lineitem(spark, sf):
    """Keep-first over the largest table, in order of the ship date and the other columns."""
    li = table(spark, sf, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    first = cleaning.keep_first(li, ["l_orderkey", "l_linenumber"], [F.col(c) for c in order])
    return out(first.select("l_orderkey", "l_linenumber", *order))


def dedup_dropped_count(spark, sf):
    rows = cleaning.drop_null_critical(snap(spark, sf), CONTRACT.critical)
    return out(cleaning.duplicate_counts(rows, SNAP_KEYS))


def cast_integer(spark, sf):
    """Truncation of numbers and of numeric text, per snapshot."""
    s = snap(spark, sf)
    text = na_to_null(F.col("measure_text"))
    typed = s.select("snapshot_date",
                     try_integer(F.col("measure"), s.schema["measure"].dataType).alias("number"),
                     try_integer(text, s.schema["measure_text"].dataType).alias("text"))
    return out(typed.groupBy("snapshot_date").agg(
        F.count("number").alias("numbers"), F.sum("number").alias("number_sum"),
        F.count("text").alias("texts"), F.sum("text").alias("text_sum")))


def parse_snapshot_date(spark, sf):
    s = snap(spark, sf)
    day = try_date(F.col("date_text"), s.schema["date_text"].dataType)
    return out(s.groupBy(day.alias("parsed_date")).agg(
        F.count("*").alias("row_count"),
        F.count_if(day == F.col("snapshot_date")).alias("equal_rows")))


def cast_rejects(spark, sf):
    s = snap(spark, sf).withColumn("measure_text", na_to_null(F.col("measure_text")))
    bad = cleaning.cast_rejects(s, TEXT_CONTRACT)
    return out(bad.select("src_pos", "snapshot_date", "measure_text",
                          F.array_join("_rejects", ",").alias("rejected")))


QUERIES = {
    "silver_clean": (silver_clean, f"""with {SNAP}, {CLEAN}
select src_pos, cast(snapshot_date as varchar) as snapshot_date, entity_id, category, period,
       cast(trunc(measure) as bigint) as measure from firsts"""),
    "silver_clean_drop": (silver_clean_drop, f"""with {SNAP},
r as (select *, nullif(measure_text, 'NA') as cell from snap),
g as (select *, cell is not null and not regexp_full_match(cell, '[+-]?[0-9]+([.][0-9]+)?') as bad from r),
k as (select src_pos, row_number() over (
        partition by entity_id, period, category, snapshot_date order by src_pos) as rn
      from g where entity_id is not null and category is not null and period is not null and cell is not null and not bad)
select 'silver' as kind, src_pos from k where rn = 1
union all select 'reject', src_pos from g where bad"""),
    "dropna_critical": (dropna_critical, f"""with {SNAP}, {CLEAN}
select src_pos, cast(snapshot_date as varchar) as snapshot_date, entity_id, category, period from kept"""),
    "silver_row_accounting": (silver_row_accounting, f"""with {SNAP}, {CLEAN},
a as (select snapshot_date, count(*) as n from snap group by 1),
b as (select snapshot_date, count(*) as n from kept group by 1),
c as (select snapshot_date, count(*) as n from firsts group by 1)
select cast(a.snapshot_date as varchar) as snapshot_date, a.n as rows_in,
       coalesce(b.n, 0) as rows_after_nulls, coalesce(c.n, 0) as rows_after_dedup,
       a.n - coalesce(b.n, 0) as dropped_nulls, coalesce(b.n, 0) - coalesce(c.n, 0) as dropped_duplicates
from a left join b using (snapshot_date) left join c using (snapshot_date)"""),
    "dedup_keep_first": (dedup_keep_first, f"""with {SNAP}, {CLEAN}
select src_pos, cast(snapshot_date as varchar) as snapshot_date, entity_id, category, period from firsts"""),
    "dedup_keep_first_lineitem": (dedup_lineitem, """
select l_orderkey, l_linenumber, cast(d as varchar) as l_shipdate, l_partkey, l_suppkey, l_quantity,
       l_extendedprice from (
  select *, cast(l_shipdate as date) as d, row_number() over (
      partition by l_orderkey, l_linenumber
      order by cast(l_shipdate as date), l_partkey, l_suppkey, l_quantity, l_extendedprice) as rn
  from lineitem) where rn = 1"""),
    "dedup_dropped_count": (dedup_dropped_count, f"""with {SNAP}, {CLEAN},
k as (select snapshot_date, count(*) as n from kept
      group by snapshot_date, entity_id, period, category)
select cast(snapshot_date as varchar) as snapshot_date, cast(sum(n - 1) as bigint) as duplicate_rows,
       count(*) filter (n > 1) as duplicated_keys from k group by 1"""),
    "cast_integer": (cast_integer, f"""with {SNAP},
t as (select snapshot_date,
        case when not isnan(measure) then cast(trunc(measure) as bigint) end as number,
        case when regexp_full_match(measure_text, '[+-]?[0-9]+([.][0-9]+)?')
             then cast(trunc(cast(measure_text as double)) as bigint) end as text from snap)
select cast(snapshot_date as varchar) as snapshot_date, count(number) as numbers,
       cast(sum(number) as bigint) as number_sum, count(text) as texts,
       cast(sum(text) as bigint) as text_sum from t group by 1"""),
    "parse_snapshot_date": (parse_snapshot_date, f"""with {SNAP}
select cast(cast(date_text as date) as varchar) as parsed_date, count(*) as row_count,
       count(*) filter (cast(date_text as date) = snapshot_date) as equal_rows from snap group by 1"""),
    "cast_rejects": (cast_rejects, f"""with {SNAP}
select src_pos, cast(snapshot_date as varchar) as snapshot_date, measure_text,
       'measure_text' as rejected from snap
where measure_text <> 'NA' and not regexp_full_match(measure_text, '[+-]?[0-9]+([.][0-9]+)?')"""),
}
