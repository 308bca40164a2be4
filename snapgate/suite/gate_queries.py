"""Data quality, Gold and alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapgate.operators import alerts as al, gold, quality as dq, rules as rl, schema_gate as sg
from snapgate.sinks import publish
from snapgate.sinks.layers import read_gold, write_gold
from snapgate.sinks.scratch import cut_lineage, scratch_dir
from snapgate.suite import drift_queries as dr
from snapgate.suite.inputs import CONTRACT, LIMITS, SNAP, TEXT_CONTRACT, out, snap, table, yearly_orders
from snapgate.functions.text import na_to_null

RUN_TS = "2024-02-01T00:00:00"
QUALITY_COLUMNS = ["entity_id", "category", "measure"]


def _measured(spark, sf):
    counts = dq.snapshot_metrics(snap(spark, sf), QUALITY_COLUMNS)
    return dq.row_count_change(counts)


def dq_row_count_change(spark, sf):
    m = _measured(spark, sf).where("previous_count is not null")
    return out(m.select("snapshot_date", "row_count", "previous_count",
                        F.round("row_count_change_pct", 4).alias("row_count_change_pct")))


def dq_null_pct(spark, sf):
    nulls = dq.null_percentages(dq.snapshot_metrics(snap(spark, sf), QUALITY_COLUMNS), QUALITY_COLUMNS)
    return out(nulls.withColumn("null_pct", F.round("null_pct", 4)))


def dq_status(spark, sf):
    s = dq.quality_status(_measured(spark, sf), LIMITS)
    return out(s.select("snapshot_date", "row_count", "status", F.array_join("reasons", ",").alias("reasons")))


def dq_status_latest_record(spark, sf):
    """Every category's snapshots against the category's newest record, whatever its date."""
    s = snap(spark, sf)
    counts = s.groupBy(F.col("category").alias("dataset"), "snapshot_date").agg(
        F.count("*").alias("row_count"), F.count_if(F.col("entity_id").isNull()).alias("nulls_entity_id"),
        F.count_if(F.col("category").isNull()).alias("nulls_category"))
    history = counts.select("dataset", "snapshot_date", F.lit(1).alias("run_seq"), "row_count")
    status = dq.quality_status(dq.row_count_change_from_history(counts, history), LIMITS)
    return out(status.select("dataset", "snapshot_date", "row_count", "previous_count", "status"))


def dq_record(spark, sf):
    rec = dq.quality_record(_measured(spark, sf), LIMITS)
    nulls = F.explode("null_percentages").alias("column", "null_pct")
    return out(rec.select("snapshot_date", "row_count", "status", "row_count_change_pct", nulls)
               .where("row_count_change_pct is not null"))


def _order_rules():
    return [rl.Holds("price above 1000", "o_totalprice > 1000"), rl.Holds("no urgent pending order", F.expr("not (o_orderstatus = 'P' and o_orderpriority = '1-URGENT')")),
            rl.Holds("half of the customers", "if(o_custkey % 3 = 0, null, o_custkey % 2 = 0)", strict=True, limit_pct=70.0),
            rl.Unique("one order a customer and priority", ("o_custkey", "o_orderpriority"), limit_pct=50.0)]


def rules_rows(spark, sf):
    """Conditions and a unique key over every order, by year."""
    found = rl.check_rows(yearly_orders(spark, sf), _order_rules(), "snapshot_year")
    return found.withColumn("violated_pct", F.round("violated_pct", 4))


def rules_reference(spark, sf):
    """The line items whose part or order the other tables, cut by a rule, do not have, and the rules they break."""
    lines = table(spark, sf, "lineitem").withColumn("snapshot_year", F.year("l_shipdate"))
    parts = table(spark, sf, "part").where("p_size <= 45")
    orders = table(spark, sf, "orders").where("o_orderkey % 50 <> 0").select("o_orderkey")
    rules = [rl.References("part", ("l_partkey",), parts, ("p_partkey",)), rl.Holds("tax", "l_tax < 0.08"),
             rl.References("order", ("l_orderkey",), orders, ("o_orderkey",))]
    broken = cut_lineage(rl.broken_keys(cut_lineage(rl.key_counts(lines, rules, "snapshot_year")), rules, "snapshot_year"))
    rows = rl.violating_rows(lines, rules, broken, "snapshot_year")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_tax", F.array_join("_violations", ",").alias("violations"))


GOLD_KEYS = ["o_custkey", "snapshot_year"]
GOLD_COLUMNS = ["o_custkey", "snapshot_year", "o_orderkey", "o_orderstatus", "o_totalprice"]


def _sides(spark, sf):
    """Open orders are what the table holds; finished and pending ones are merged into it."""
    o = yearly_orders(spark, sf)
    target = gold.last_wins(o.where("o_orderstatus = 'O'"), GOLD_KEYS, ["o_orderkey"])
    return target.select(*GOLD_COLUMNS), o.where("o_orderstatus <> 'O'").select(*GOLD_COLUMNS)


def gold_last_wins(spark, sf):
    return gold.last_wins(yearly_orders(spark, sf), GOLD_KEYS, ["o_orderkey"]).select(*GOLD_COLUMNS)


def gold_upsert(spark, sf):
    target, source = _sides(spark, sf)
    return gold.upsert(target, source, GOLD_KEYS, ["o_orderkey"])


def gold_upsert_stored(spark, sf):
    """The same merge through the partitioned table, with the source applied twice."""
    target, source = _sides(spark, sf)
    path = scratch_dir(spark)
    for rows in (target, source, source):
        stored = gold.touched(read_gold(spark, path, source.schema), rows, "snapshot_year")
        write_gold(rows, stored, path, GOLD_KEYS, ["o_orderkey"], "snapshot_year")
    return read_gold(spark, path, source.schema).select(*GOLD_COLUMNS)


def gold_publish(spark, sf):
    """Two loads published with their ledger, each raced by a load that started from the state before and must fail."""
    target, source = _sides(spark, sf)
    path, schema = scratch_dir(spark), target.schema
    state = publish.head(spark, path)
    for i, rows in enumerate((target, source)):
        years = {str(r[0]): f"2024-02-0{i + 1} 00:00:00" for r in rows.select("snapshot_year").distinct().collect()}
        merged = gold.merge(publish.read_published(spark, path, schema, state), rows, GOLD_KEYS, ["o_orderkey"]).select(*GOLD_COLUMNS)
        won = publish.publish(merged, path, "snapshot_year", state, years)
        try:
            publish.publish(merged.withColumn("o_totalprice", F.lit(0.0)), path, "snapshot_year", state, years)
        except publish.TakenError:
            state = won
    ledger = spark.createDataFrame(list(state.snapshots.items()), "snapshot_year string, processed_at string")
    stored = publish.read_published(spark, path, schema)
    return stored.join(ledger, stored["snapshot_year"].cast("string") == ledger["snapshot_year"]).select(
        *(stored[c] for c in GOLD_COLUMNS), "processed_at")


def gold_upsert_null_partition(spark, sf):
    """The stored merge where a seventh of the customers have no partition value."""
    year = F.expr("if(o_custkey % 7 = 0, null, snapshot_year)")
    target, source = (side.withColumn("snapshot_year", year) for side in _sides(spark, sf))
    path = scratch_dir(spark)
    for rows in (target, source.where("o_orderkey % 2 = 0"), source):
        stored = gold.touched(read_gold(spark, path, source.schema), rows, "snapshot_year")
        write_gold(rows, stored, path, GOLD_KEYS, ["o_orderkey"], "snapshot_year")
    return read_gold(spark, path, source.schema).select(*GOLD_COLUMNS)


def gold_upsert_counts(spark, sf):
    target, source = _sides(spark, sf)
    return gold.upsert_counts(target, source, GOLD_KEYS, "snapshot_year")


def gold_projection(spark, sf):
    o = gold.tag_version(yearly_orders(spark, sf), "v1")
    return gold.last_wins(o, GOLD_KEYS, ["o_orderkey"]).select(*GOLD_COLUMNS, "schema_version")


def _ledger(spark, sf):
    """The ledger lists the years in which an order is already finished in the first half."""
    o = yearly_orders(spark, sf)
    return gold.ledger_rows(o.where("snapshot_year < 1998"), RUN_TS, "snapshot_year")


def pending_snapshots(spark, sf):
    o = yearly_orders(spark, sf)
    return gold.pending_snapshots(o, _ledger(spark, sf), "snapshot_year")


def pending_rows(spark, sf):
    o = yearly_orders(spark, sf)
    pend = gold.pending_rows(o, _ledger(spark, sf), "snapshot_year")
    return pend.groupBy("snapshot_year", "o_orderstatus").agg(F.count("*").alias("row_count"))


def ledger_after_load(spark, sf):
    o, ledger = yearly_orders(spark, sf), _ledger(spark, sf)
    loaded = gold.pending_rows(o, ledger, "snapshot_year")
    both = ledger.unionByName(gold.ledger_rows(loaded, "2024-02-02 00:00:00", "snapshot_year"))
    return out(both)


def _gate_alerts(spark, sf):
    s = snap(spark, sf).withColumn("measure_text", na_to_null(F.col("measure_text")))
    # each gate's output is read once here, so only the profiles below the drift records are stored
    cards, judged = sg.scorecard(s, TEXT_CONTRACT), dq.quality_status(_measured(spark, sf), LIMITS)
    drifted = dr.rounded(dr._records(spark, sf), ["baseline", "current", "drift_pct"])
    return al.union_alerts([al.schema_alerts(cards, RUN_TS), al.quality_alerts(judged, RUN_TS), al.drift_alerts(drifted, RUN_TS)])


def alerts_union(spark, sf):
    """All gates' alerts; the numbers of the drift details are left to the drift queries."""
    a = _gate_alerts(spark, sf)
    details = F.when(F.col("source") == "DRIFT_DETECTOR",
                     F.concat_ws(",", F.json_object_keys("details"))).otherwise(F.col("details"))
    return a.withColumn("details", details)


def alerts_summary(spark, sf):
    return _gate_alerts(spark, sf).groupBy("source", "severity").agg(
        F.count("*").alias("alerts"), F.countDistinct("snapshot_date").alias("snapshots"))


_DQ = f"""{SNAP},
m as (select snapshot_date, count(*) as row_count, count(*) filter (entity_id is null) as e,
             count(*) filter (category is null) as c,
             count(*) filter (measure is null or isnan(measure)) as x from snap group by 1),
l as (select *, lag(row_count) over (order by snapshot_date) as prev from m),
q as (select *, abs(row_count - prev) / prev * 100 as chg, e * 100.0 / row_count as ep from l),
st as (select *, case when ep > 1 then 'FAILED' when chg > 5 then 'WARN' else 'PASSED' end as status from q)"""
_DAY = "cast(snapshot_date as varchar) as snapshot_date"
_ORD = """o as (select o_custkey, cast(year(o_orderdate) as int) as snapshot_year, o_orderkey, o_orderstatus,
             o_orderpriority, o_totalprice from orders)"""
_SIDES = f"""{_ORD},
t as (select * from (select *, row_number() over (
        partition by o_custkey, snapshot_year order by o_orderkey desc) as rn
      from o where o_orderstatus = 'O') where rn = 1),
s as (select * from o where o_orderstatus <> 'O'),
merged as (
  select * from (select *, row_number() over (
      partition by o_custkey, snapshot_year order by p desc, o_orderkey desc) as rk
    from (select o_custkey, snapshot_year, o_orderkey, o_orderstatus, o_totalprice, 0 as p from t
          union all select o_custkey, snapshot_year, o_orderkey, o_orderstatus, o_totalprice, 1 from s))
  where rk = 1)"""
_GOLD = "select o_custkey, snapshot_year, o_orderkey, o_orderstatus, o_totalprice"
_LEDGER = "ledger as (select distinct snapshot_year from o where snapshot_year < 1998)"

_ALERTS = f"""{dr.CHAIN},
{_DQ.replace(SNAP + ',', '')},
tx as (select snapshot_date, count(*) as row_count,
              count(*) filter (measure_text <> 'NA' and not regexp_full_match(measure_text, '[+-]?[0-9]+')) as bad,
              count(*) filter (measure_text = 'NA') as nulls from snap group by 1),
alerts as (
  select 'CRITICAL' as severity, 'SCHEMA_CHECK' as source, snapshot_date,
         'Schema enforcement failed' as message,
         '{{"checks_passed":' || case when bad > 0 then '2' else '3' end
           || ',"missing_columns":[],"uncastable_columns":[' || case when bad > 0 then '"measure_text"' else '' end
           || '],"null_columns":[' || case when nulls > 0 then '"measure_text"' else '' end || ']}}' as details
  from tx where bad > 0 or nulls > 0
  union all
  select 'CRITICAL', 'DATA_QUALITY', snapshot_date, 'Null percentage threshold exceeded',
         '{{"row_count":' || row_count || ',"reason":"nulls:entity_id"}}' from q where ep > 1
  union all
  select 'WARN', 'DATA_QUALITY', snapshot_date, 'Row count drift detected',
         '{{"row_count":' || row_count || ',"reason":"row count"}}' from q where chg > 5
  union all
  select severity, 'DRIFT_DETECTOR', snapshot_date,
         case when type = 'numeric' then 'Numeric drift detected: ' || "column" || ':' || metric
              else 'Categorical drift detected: ' || "column" end,
         'baseline,current,drift_pct'
  from records where severity <> 'INFO')"""

QUERIES = {
    "dq_row_count_change": (dq_row_count_change, f"""with {_DQ}
select {_DAY}, row_count, prev as previous_count, round(chg, 4) as row_count_change_pct
from q where prev is not null"""),
    "dq_null_pct": (dq_null_pct, f"""with {_DQ},
n as (select snapshot_date, row_count, 'entity_id' as "column", e as null_values from m
      union all select snapshot_date, row_count, 'category', c from m
      union all select snapshot_date, row_count, 'measure', x from m)
select {_DAY}, row_count, "column", null_values, round(null_values * 100.0::double / row_count, 4) as null_pct
from n"""),
    "dq_status": (dq_status, f"""with {_DQ}
select {_DAY}, row_count, status,
       concat_ws(',', case when ep > 1 then 'nulls:entity_id' end, case when chg > 5 then 'row count' end)
         as reasons from st"""),
    "dq_status_latest_record": (dq_status_latest_record, f"""with {SNAP},
c as (select category as dataset, snapshot_date, count(*) as row_count,
             count(*) filter (entity_id is null) as e from snap group by all),
last as (select dataset, arg_max(row_count, snapshot_date) as prev from c group by 1)
select c.dataset, cast(c.snapshot_date as varchar) as snapshot_date, c.row_count, l.prev as previous_count,
       case when c.e * 100.0 / c.row_count > 1 then 'FAILED'
            when abs(c.row_count - l.prev) / l.prev * 100 > 5 then 'WARN' else 'PASSED' end as status
from c join last l using (dataset)"""),
    "dq_record": (dq_record, f"""with {_DQ}
select {_DAY}, row_count, status, round_even(chg, 2) as row_count_change_pct, 'entity_id' as "column",
       round_even(ep::double, 2) as null_pct from st where chg is not null
union all
select {_DAY}, row_count, status, round_even(chg, 2), 'category',
       round_even(c * 100.0::double / row_count, 2) from st where chg is not null"""),
    "rules_rows": (rules_rows, f"""with {_ORD},
u as (select *, count(*) over (partition by snapshot_year, o_custkey, o_orderpriority) as same from o),
b as (select snapshot_year, unnest(['price above 1000', 'no urgent pending order', 'half of the customers',
                                    'one order a customer and priority']) as rule,
             unnest([o_totalprice <= 1000, o_orderstatus = 'P' and o_orderpriority = '1-URGENT',
                     o_custkey % 3 = 0 or o_custkey % 2 <> 0, same > 1]) as bad from u),
c as (select snapshot_year, rule, count(*) as row_count, count(*) filter (bad) as violations from b group by 1, 2)
select *, round(violations / row_count * 100, 4) as violated_pct,
       case when violations / row_count * 100 > case rule when 'half of the customers' then 70
                 when 'one order a customer and priority' then 50 else 0 end then 'FAILED' else 'PASSED' end as status from c"""),
    "rules_reference": (rules_reference, """
with l as (select l_orderkey, l_linenumber, l_partkey, l_tax,
                  l_partkey not in (select p_partkey from part where p_size <= 45) as no_part, l_tax >= 0.08 as high,
                  l_orderkey not in (select o_orderkey from orders where o_orderkey % 50 <> 0) as no_order from lineitem)
select l_orderkey, l_linenumber, l_partkey, l_tax,
       concat_ws(',', case when no_part then 'part' end, case when high then 'tax' end, case when no_order then 'order' end) as violations
from l where no_part or high or no_order"""),
    "gold_last_wins": (gold_last_wins, f"""with {_ORD}
{_GOLD} from (select *, row_number() over (
  partition by o_custkey, snapshot_year order by o_orderkey desc) as rn from o) where rn = 1"""),
    "gold_upsert": (gold_upsert, f"with {_SIDES}\n{_GOLD} from merged"),
    "gold_upsert_stored": (gold_upsert_stored, f"with {_SIDES}\n{_GOLD} from merged"),
    "gold_publish": (gold_publish, f"""with {_SIDES}
select m.o_custkey, m.snapshot_year, m.o_orderkey, m.o_orderstatus, m.o_totalprice,
       case when snapshot_year in (select snapshot_year from s) then '2024-02-02 00:00:00'
            else '2024-02-01 00:00:00' end as processed_at from merged m"""),
    "gold_upsert_null_partition": (gold_upsert_null_partition, "with " + _SIDES.replace(
        "cast(year(o_orderdate) as int) as snapshot_year",
        "case when o_custkey % 7 <> 0 then cast(year(o_orderdate) as int) end as snapshot_year")
        + f"\n{_GOLD} from merged"),
    "gold_upsert_counts": (gold_upsert_counts, f"""with {_SIDES},
k as (select o_custkey, snapshot_year, count(*) as n,
             bool_or((o_custkey, snapshot_year) in (select (o_custkey, snapshot_year) from t)) as known
      from s group by 1, 2)
select snapshot_year, cast(sum(n) as bigint) as source_rows, count(*) as distinct_keys,
       count(*) filter (not known) as inserted, count(*) filter (known) as updated from k group by 1"""),
    "gold_projection": (gold_projection, f"""with {_ORD}
{_GOLD}, 'v1' as schema_version from (select *, row_number() over (
  partition by o_custkey, snapshot_year order by o_orderkey desc) as rn from o) where rn = 1"""),
    "pending_snapshots": (pending_snapshots, f"""with {_ORD}, {_LEDGER}
select distinct snapshot_year from o where snapshot_year not in (select snapshot_year from ledger)"""),
    "pending_rows": (pending_rows, f"""with {_ORD}, {_LEDGER}
select snapshot_year, o_orderstatus, count(*) as row_count from o
where snapshot_year not in (select snapshot_year from ledger) group by 1, 2"""),
    "ledger_after_load": (ledger_after_load, f"""with {_ORD}, {_LEDGER}
select snapshot_year, '2024-02-01 00:00:00' as processed_at from ledger
union all
select distinct snapshot_year, '2024-02-02 00:00:00' from o
where snapshot_year not in (select snapshot_year from ledger)"""),
    "alerts_union": (alerts_union, f"""{_ALERTS}
select severity, source, {_DAY}, message, details, '{RUN_TS}' as timestamp from alerts"""),
    "alerts_summary": (alerts_summary, f"""{_ALERTS}
select source, severity, count(*) as alerts, count(distinct snapshot_date) as snapshots
from alerts group by 1, 2"""),
}
