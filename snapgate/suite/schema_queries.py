"""Contract registry and schema gate."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapgate.functions.text import na_to_null
from snapgate.sinks.layers import read_registry, register_versions
from snapgate.sinks.scratch import cut_lineage, scratch_dir
from snapgate.operators import contracts, schema_gate as sg
from snapgate.suite.inputs import (CONTRACT, DELIVERED, REGISTRY, SNAP, TEXT_CONTRACT, delivered,
                                   out, registry, snap)

ON = ("snapshot_date", "dataset", "name")


def _text_snap(spark, sf):
    return snap(spark, sf).withColumn("measure_text", na_to_null(F.col("measure_text")))


def _stored_registry(spark, sf):
    """The registry as a stored table, as the gates find it."""
    return cut_lineage(registry(spark, sf))


def _sides(spark, sf):
    """The newest contract of each brand for every month the brand delivered, and what it
    delivered; the column catalog is stored once and read twice."""
    actual = cut_lineage(delivered(spark, sf))
    newest = contracts.latest_contract(_stored_registry(spark, sf))
    return newest.join(actual.select("snapshot_date", "dataset").distinct(), "dataset"), actual


def registry_latest_version(spark, sf):
    newest = contracts.latest_contract(_stored_registry(spark, sf))
    return newest.groupBy("dataset", "version").agg(F.count("*").alias("columns"))


def critical_columns(spark, sf):
    newest = contracts.latest_contract(_stored_registry(spark, sf))
    return contracts.critical_columns(newest).select("dataset", "version", "name")


def schema_diff(spark, sf):
    r = _stored_registry(spark, sf)
    return contracts.diff_contracts(contracts.previous_contract(r), contracts.latest_contract(r))


def schema_gate_action(spark, sf):
    r = _stored_registry(spark, sf)
    return contracts.gate_actions(contracts.previous_contract(r), _grown(r))


def _grown(r):
    """An incoming contract: the version before the newest and, for a third of the brands
    each, also the newest's nullable or required columns or nothing."""
    old, new = contracts.previous_contract(r), contracts.latest_contract(r)
    extra = new.join(old, ["dataset", "name"], "left_anti")
    optional = F.coalesce("nullable", F.lit(True))
    last = F.substring("dataset", -1, 1)
    wanted = extra.where((last.isin("1", "2", "3", "4") & optional) | (last.isin("5", "6") & ~optional))
    return old.unionByName(wanted.select(*old.columns))


_GROWN = """grown as (
  select * from before
  union all
  select n.* from newest n where (n.dataset, n.name) not in (select (dataset, name) from before)
    and ((right(n.dataset, 1) in ('1', '2', '3', '4') and coalesce(n.nullable, true))
      or (right(n.dataset, 1) in ('5', '6') and not coalesce(n.nullable, true)))),
gate as (
  select b.dataset, any_value(b.version) as registered_version,
         any_value(coalesce(x.breaking, 0)) as breaking, any_value(coalesce(x.compatible, 0)) as compatible
  from before b left join (
    select dataset, count(*) filter (not coalesce(nullable, true)) as breaking,
           count(*) filter (coalesce(nullable, true)) as compatible
    from grown g where (dataset, name) not in (select (dataset, name) from before) group by 1) x
  using (dataset) group by 1),
acted as (
  select *, case when breaking > 0 then 'abort' when compatible > 0 then 'register' else 'pass' end as action
  from gate)"""


def registry_append(spark, sf):
    r = _stored_registry(spark, sf)
    old = contracts.previous_contract(r)
    path = scratch_dir(spark)
    old.write.parquet(path)
    register_versions(contracts.rows_to_register(old, _grown(r)), path)
    return read_registry(spark, path).withColumn("nullable", F.col("nullable").cast("string"))


def schema_missing_columns(spark, sf):
    return out(sg.missing_columns(*_sides(spark, sf), ON)
               .select("snapshot_date", "dataset", "version", "name"))


def schema_extra_columns(spark, sf):
    return out(sg.extra_columns(*_sides(spark, sf), ON))


def schema_type_mismatch(spark, sf):
    return out(sg.type_mismatches(*_sides(spark, sf), ON))


def schema_castability(spark, sf):
    return out(sg.castability(_text_snap(spark, sf), TEXT_CONTRACT))


def schema_null_violations(spark, sf):
    return out(sg.null_violations(snap(spark, sf), CONTRACT))


def schema_scorecard(spark, sf):
    cards = sg.scorecard(_text_snap(spark, sf), TEXT_CONTRACT)
    return out(cards.withColumns({c: F.array_join(c, ",") for c in cards.columns if c.endswith("_columns")}))


def schema_scorecard_types(spark, sf):
    """The strict type check: a double is no integer, whatever its values."""
    cards = sg.scorecard(snap(spark, sf), CONTRACT, strict_types=True)
    return out(cards.withColumns({c: F.array_join(c, ",") for c in cards.columns if c.endswith("_columns")}))


QUERIES = {
    "registry_latest_version": (registry_latest_version, f"""with {REGISTRY}
select dataset, version, count(*) as columns from newest group by all"""),
    "critical_columns": (critical_columns, f"""with {REGISTRY}
select dataset, version, name from newest where not coalesce(nullable, true)"""),
    "schema_diff": (schema_diff, f"""with {REGISTRY},
j as (select coalesce(o.dataset, n.dataset) as dataset, coalesce(o.name, n.name) as name,
             o.type as ot, n.type as nt, coalesce(o.nullable, true) as onull,
             coalesce(n.nullable, true) as nnull, o.name is not null as oin, n.name is not null as nin
      from before o full outer join newest n on o.dataset = n.dataset and o.name = n.name)
select dataset, name, 'breaking' as kind, 'Column removed: ' || name as change from j where not nin
union all select dataset, name, 'breaking', 'Type change: ' || name || ' (' || ot || ' → ' || nt || ')'
  from j where oin and nin and ot <> nt
union all select dataset, name, 'breaking', 'Nullable → non-nullable: ' || name
  from j where oin and nin and onull and not nnull
union all select dataset, name, 'relaxed', 'Non-nullable → nullable: ' || name
  from j where oin and nin and not onull and nnull
union all select dataset, name, 'compatible', 'New nullable column: ' || name from j where not oin and nnull
union all select dataset, name, 'breaking', 'New non-nullable column: ' || name
  from j where not oin and not nnull"""),
    "schema_gate_action": (schema_gate_action, f"""with {REGISTRY}, {_GROWN}
select *, case when action = 'register' then 'v' || cast(cast(substr(registered_version, 2) as int) + 1 as varchar)
               else registered_version end as effective_version from acted"""),
    "registry_append_rows": (registry_append, f"""with {REGISTRY}, {_GROWN}
select dataset, version, name, type, cast(nullable as varchar) as nullable from before
union all
select g.dataset, 'v' || cast(cast(substr(a.registered_version, 2) as int) + 1 as varchar), g.name, g.type,
       cast(g.nullable as varchar)
from grown g join acted a using (dataset) where a.action = 'register'"""),
    "schema_missing_columns": (schema_missing_columns, f"""with {REGISTRY}, {DELIVERED}
select cast(e.snapshot_date as varchar) as snapshot_date, e.dataset, e.version, e.name
from expected e anti join delivered d
  on e.snapshot_date = d.snapshot_date and e.dataset = d.dataset and e.name = d.name"""),
    "schema_extra_columns": (schema_extra_columns, f"""with {REGISTRY}, {DELIVERED}
select cast(d.snapshot_date as varchar) as snapshot_date, d.dataset, d.name, d.type
from delivered d anti join expected e
  on e.snapshot_date = d.snapshot_date and e.dataset = d.dataset and e.name = d.name"""),
    "schema_type_mismatch": (schema_type_mismatch, f"""with {REGISTRY}, {DELIVERED}
select cast(d.snapshot_date as varchar) as snapshot_date, d.dataset, d.name,
       e.type as expected_type, d.type as actual_type
from delivered d join expected e
  on e.snapshot_date = d.snapshot_date and e.dataset = d.dataset and e.name = d.name
where e.type <> d.type"""),
    "schema_castability": (schema_castability, f"""with {SNAP},
a as (select snapshot_date, count(*) as row_count,
             count(*) filter (measure_text <> 'NA' and not regexp_full_match(measure_text, '[+-]?[0-9]+')) as bad
      from snap group by 1)
select cast(snapshot_date as varchar) as snapshot_date, row_count, c as "column",
       case when c = 'measure_text' then bad else 0 end as bad_values
from a, unnest(['category', 'period', 'measure_text', 'date_text']) as u(c)"""),
    "schema_null_violations": (schema_null_violations, f"""with {SNAP},
a as (select snapshot_date, count(*) as row_count, count(*) filter (entity_id is null) as e,
             count(*) filter (measure is null or isnan(measure)) as m from snap group by 1)
select cast(snapshot_date as varchar) as snapshot_date, row_count, 'entity_id' as "column", e as null_values
from a where e > 0
union all select cast(snapshot_date as varchar), row_count, 'measure', m from a where m > 0"""),
    "schema_scorecard": (schema_scorecard, f"""with {SNAP},
a as (select snapshot_date, count(*) as row_count,
             count(*) filter (measure_text <> 'NA' and not regexp_full_match(measure_text, '[+-]?[0-9]+')) as bad,
             count(*) filter (measure_text = 'NA') as nulls from snap group by 1),
p as (select *, case when bad > 0 then 2 when nulls > 0 then 3 else 4 end as passed from a)
select cast(snapshot_date as varchar) as snapshot_date, 'v2' as schema_version, row_count,
       '' as missing_columns, case when bad > 0 then 'measure_text' else '' end as uncastable_columns,
       case when nulls > 0 then 'measure_text' else '' end as null_columns, passed as checks_passed,
       case when passed < 4 then 1 else 0 end as checks_failed,
       case when passed < 4 then 'FAILED' else 'PASSED' end as status from p"""),
    "schema_scorecard_types": (schema_scorecard_types, f"""with {SNAP}
select cast(snapshot_date as varchar) as snapshot_date, 'v1' as schema_version, count(*) as row_count,
       '' as missing_columns, 'measure' as uncastable_columns,
       concat_ws(',', case when count(*) filter (entity_id is null) > 0 then 'entity_id' end,
                 case when count(*) filter (measure is null or isnan(measure)) > 0 then 'measure' end) as null_columns,
       2 as checks_passed, 1 as checks_failed, 'FAILED' as status from snap group by 1"""),
}
