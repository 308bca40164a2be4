"""Profiles, baselines and drift."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from snapgate.operators import baseline as bl, drift, heavy, mergeable as mg, profile as pf
from snapgate.operators.quantiles import select_quantiles
from snapgate.sinks.scratch import cut_lineage
from snapgate.suite.inputs import CALENDAR, CATEGORICAL, NUMERIC, SNAP, calendar, out, snap, table

WINDOW = 7


def rounded(df, columns, places=4):
    return df.withColumns({c: F.round(c, places) for c in columns})


_STATS = ["mean", "median", "std", "min", "max", "p25", "p50", "p75"]


def _numeric(spark, sf):
    return pf.profile_numeric(snap(spark, sf), NUMERIC)


def _categorical(spark, sf):
    return pf.profile_categorical(snap(spark, sf), CATEGORICAL)


def _stored(profile):
    """Profiles go to the metric history; baselines and drift start from the stored records."""
    return cut_lineage(profile)


def _baselines(profile, fold):
    members = bl.window_members(profile.select("snapshot_date"), WINDOW)
    return fold(bl.history_of(profile, members))


def profile_numeric(spark, sf):
    return out(rounded(_numeric(spark, sf), _STATS))


def _sold(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.year("l_shipdate").alias("snapshot_year"), "l_quantity", "l_extendedprice", "l_discount")


_LI_NUM = ["l_quantity", "l_extendedprice", "l_discount"]


def profile_numeric_lineitem(spark, sf):
    return rounded(pf.profile_numeric(_sold(spark, sf), _LI_NUM, "snapshot_year"), _STATS)


def profile_numeric_narrowing(spark, sf):
    """The same profile with ranges of a thousand values sorted at the end."""
    return rounded(pf.profile_numeric(_sold(spark, sf), _LI_NUM, "snapshot_year", sort_rows=1000),
                   _STATS)


def quantile_selection(spark, sf):
    """Exact deciles of prices per line status by narrowing rounds."""
    li = table(spark, sf, "lineitem")
    found = select_quantiles(li, ["l_linestatus", "l_returnflag"], ["l_extendedprice"],
                             [i / 10 for i in range(11)],
                             sort_rows=1000)
    return rounded(found, ["value"])


def value_counts(spark, sf):
    return out(pf.value_counts(snap(spark, sf), CATEGORICAL))


def profile_categorical(spark, sf):
    return out(_categorical(spark, sf).select("snapshot_date", "column", "count", "cardinality"))


def profile_empty_snapshots(spark, sf):
    """Records of count 0 for the calendar days without rows."""
    p = pf.cover_profiles(calendar(spark, sf), _categorical(spark, sf), CATEGORICAL)
    return out(p.select("snapshot_date", "column", "count", "cardinality", F.size("top_5_values").alias("top")))


def profile_categorical_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("snapshot_year", F.year("l_shipdate"))
    p = pf.profile_categorical(li, ["l_returnflag", "l_linestatus", "l_suppkey"], "snapshot_year")
    return p.select("snapshot_year", "column", "count", "cardinality")


def profile_top5(spark, sf):
    top = _categorical(spark, sf).select("snapshot_date", "column",
                                         F.explode("top_5_values").alias("value", "n"))
    return out(top)


def top_values_ranked(spark, sf):
    """The ten most frequent senders of each language, over the documents."""
    d = table(spark, sf, "documents").select(F.col("lang").alias("snapshot_date"), "source")
    return pf.top_values(pf.value_counts(d, ["source"]), 10).withColumnRenamed("snapshot_date", "lang")


def top_values_bounded(spark, sf):
    """The five most frequent values a year of columns with few, many and nearly unique values."""
    rows = table(spark, sf, "lineitem").withColumn("snapshot_year", F.year("l_shipdate"))
    return heavy.top_values_bounded(rows, _TOP, 5, "snapshot_year")


_TOP = ["l_returnflag", "l_partkey", "l_orderkey"]


def profile_missing_columns(spark, sf):
    return out(pf.missing_profile_columns(snap(spark, sf), ["measure", "weight", "category", "region"]))


def baseline_window_members(spark, sf):
    return out(bl.window_members(snap(spark, sf), WINDOW))


def baseline_previous_snapshots(spark, sf):
    newest = snap(spark, sf).agg(F.max("snapshot_date")).first()[0]
    return out(bl.previous_snapshots(snap(spark, sf), newest, WINDOW))


def _windowed(spark, sf, state):
    """The state records of each snapshot's window, from stored ones, and the window's members."""
    s = snap(spark, sf)
    members = cut_lineage(bl.window_members(s, WINDOW))
    return bl.history_of(cut_lineage(state(s)), members), members, s


def baseline_pooled_moments(spark, sf):
    """Mean and deviation over all rows of the window, from the profiles alone."""
    history, _, _ = _windowed(spark, sf, lambda s: pf.profile_numeric(s, NUMERIC))
    return out(rounded(mg.pooled_moments(history), ["pooled_mean", "pooled_std"]))


def _window_rows(members, s, columns):
    return members.join(s.select(F.col("snapshot_date").alias("member"), *columns), "member").drop("member")


def window_quantiles(spark, sf):
    """Quartiles over the window's rows from stored bucket counts: do they hold the exact ones, found from the rows?"""
    history, members, s = _windowed(spark, sf, lambda s: mg.bucket_counts(s, NUMERIC))
    rough = mg.window_quantiles(history, [0.25, 0.5, 0.75])
    exact = select_quantiles(s, ["snapshot_date"], NUMERIC, [0.25, 0.5, 0.75], members=members)
    both = rough.join(exact.withColumnRenamed("value", "exact"), ["snapshot_date", "column", "prob"])
    width = F.abs("exact") * (math.exp(1 / 64) - 1) * 1.001 + 1e-9
    holds = F.col("exact").between(F.col("low"), F.col("high")) & (F.abs(F.col("value") - F.col("exact")) <= width)
    return out(both.select("snapshot_date", "column", "prob", "rows", F.round("exact", 4).alias("exact"), holds.alias("within")))


def distinct_window(spark, sf):
    """Distinct values of the window from stored sketches against the exact number, within five percent."""
    history, members, s = _windowed(spark, sf, lambda s: mg.distinct_sketches(s, CATEGORICAL))
    rough = mg.window_distinct(history)
    exact = pf.value_counts(_window_rows(members, s, CATEGORICAL), CATEGORICAL).groupBy("snapshot_date", "column").agg(
        F.count("*").alias("exact"))
    near = F.abs(F.col("distinct_values") - F.col("exact")) <= F.greatest(F.col("exact") * 0.05, F.lit(0.5))
    return out(rough.join(exact, ["snapshot_date", "column"]).select("snapshot_date", "column", "exact", near.alias("within")))


def baseline_numeric(spark, sf):
    return out(rounded(_baselines(_stored(_numeric(spark, sf)), bl.numeric_baseline), _STATS))


def baseline_rolling(spark, sf):
    return out(rounded(bl.rolling_baseline(_numeric(spark, sf), WINDOW), _STATS))


def baseline_categorical(spark, sf):
    base = _baselines(_stored(_categorical(spark, sf)), bl.categorical_baseline)
    return out(rounded(base.select("snapshot_date", "column", "avg_cardinality", "history_snapshots"),
                       ["avg_cardinality"]))


def baseline_top_values(spark, sf):
    base = _baselines(_stored(_categorical(spark, sf)), bl.categorical_baseline)
    values = base.select("snapshot_date", "column", F.explode("top_values").alias("value", "avg_count"))
    return out(rounded(values, ["avg_count"]))


def baseline_seen_values(spark, sf):
    base = _baselines(_stored(_categorical(spark, sf)), bl.categorical_baseline)
    return out(base.select("snapshot_date", "column", F.array_join("seen_values", ",").alias("seen_values")))


def _rerun_baselines(spark, sf):
    """Two runs per snapshot: first over three snapshots, then over seven."""
    p = _stored(_numeric(spark, sf))
    return [bl.rolling_baseline(p, w).withColumns({"run_seq": F.lit(i + 1), "type": F.lit("numeric")})
            for i, w in enumerate((3, WINDOW))]


def baseline_last_record(spark, sf):
    first, second = _rerun_baselines(spark, sf)
    last = drift.last_baseline(first.unionByName(second.where("column = 'measure'")))
    return out(rounded(last.select("snapshot_date", "column", "mean", "median", "run_seq"),
                       ["mean", "median"]))


def _numeric_drift(spark, sf):
    p = _stored(_numeric(spark, sf))
    return drift.numeric_drift(p, bl.rolling_baseline(p, WINDOW))


def _categorical_drift(spark, sf):
    p = _stored(_categorical(spark, sf))
    return drift.categorical_drift(p, _baselines(p, bl.categorical_baseline))


_D = ["baseline", "current", "drift_pct"]


def drift_distribution(spark, sf):
    """Each day's values against those of all rows of its window."""
    s = snap(spark, sf)
    counts = cut_lineage(pf.value_counts(s, CATEGORICAL))
    base = bl.history_of(counts, bl.window_members(s, WINDOW)).groupBy("snapshot_date", "column", "value").agg(F.sum("n").alias("n"))
    found = drift.distribution_drift(counts, base)
    names = {c: F.array_join(c, ",") for c in ("new_named", "vanished_named")}
    return out(rounded(found, ["js_distance", "psi"]).withColumns(names))


def drift_numeric(spark, sf):
    return out(rounded(_numeric_drift(spark, sf).drop("type"), _D))


def drift_categorical(spark, sf):
    return out(rounded(_categorical_drift(spark, sf).drop("type"), _D))


def _records(spark, sf):
    return drift.drift_records(_numeric_drift(spark, sf), _categorical_drift(spark, sf))


def drift_records(spark, sf):
    return out(rounded(_records(spark, sf), _D))


def drift_severity(spark, sf):
    return _records(spark, sf).groupBy("type", "column", "severity").agg(F.count("*").alias("records"))


def drift_gate(spark, sf):
    return out(drift.drift_gate(_records(spark, sf)))


def drift_bootstrap(spark, sf):
    return out(drift.gate_with_bootstrap(snap(spark, sf), _records(spark, sf)))


def _stats_sql(v):
    return f"""count({v}) as count, avg({v}) as mean, median({v}) as median,
             coalesce(stddev_pop({v}), 0.0) as std, min({v}) as min, max({v}) as max,
             quantile_cont({v}, 0.25) as p25, quantile_cont({v}, 0.5) as p50,
             quantile_cont({v}, 0.75) as p75"""


PROFILE = f"""nums as (
  select snapshot_date, 'measure' as "column", case when not isnan(measure) then measure end as v from snap
  union all select snapshot_date, 'amount', cast(amount as double) from snap),
prof as (select snapshot_date, "column", {_stats_sql('v')} from nums group by 1, 2)"""

_ROUND = ", ".join(f"round({m}, 4) as {m}" for m in _STATS)


def _frame(n):
    w = f'over (partition by "column" order by snapshot_date rows between {n} preceding and 1 preceding)'
    return f"""select snapshot_date, "column", avg(mean) {w} as mean, median(median) {w} as median,
         avg(std) {w} as std, min(min) {w} as min, max(max) {w} as max, avg(p25) {w} as p25,
         avg(p50) {w} as p50, avg(p75) {w} as p75, count(*) {w} as history_snapshots from prof"""


BASE = f"base as (select * from ({_frame(7)}) where history_snapshots > 0)"

VC = """vc as (
  select snapshot_date, 'category' as "column", category as value, count(*) as n from snap
  where category is not null group by all
  union all select snapshot_date, 'period', period, count(*) from snap where period is not null group by all
  union all select snapshot_date, 'entity_id', cast(entity_id as varchar), count(*) from snap
  where entity_id is not null group by all),
top5 as (select * exclude (rk) from (select *, row_number() over (
    partition by snapshot_date, "column" order by n desc, value) as rk from vc) where rk <= 5),
cprof as (select snapshot_date, "column", cast(sum(n) as bigint) as count, count(*) as cardinality
          from vc group by 1, 2)"""

MEMBERS = """days as (select snapshot_date, row_number() over (order by snapshot_date) as r
         from (select distinct snapshot_date from snap)),
members as (select a.snapshot_date, b.snapshot_date as member from days a join days b
            on b.r between a.r - 7 and a.r - 1)"""

CBASE = """cbase as (
  select m.snapshot_date, p."column", avg(p.cardinality) as avg_cardinality, count(*) as history_snapshots
  from members m join cprof p on p.snapshot_date = m.member group by 1, 2),
tbase as (
  select m.snapshot_date, t."column", t.value, avg(t.n) as avg_count
  from members m join top5 t on t.snapshot_date = m.member group by 1, 2, 3)"""

_SEV = "case when drift_pct >= 30 then 'CRITICAL' when drift_pct >= 10 then 'WARN' else 'INFO' end"
_LONG = " union all ".join(
    f"""select p.snapshot_date, p."column", 'numeric' as type, '{m}' as metric, b.{m} as baseline,
       p.{m} as current from prof p join base b on p.snapshot_date = b.snapshot_date and p."column" = b."column"
""" for m in _STATS)
RECORDS = f"""raw as ({_LONG} union all
  select p.snapshot_date, p."column", 'categorical', 'cardinality', b.avg_cardinality,
         cast(p.cardinality as double)
  from cprof p join cbase b on p.snapshot_date = b.snapshot_date and p."column" = b."column"),
pct as (select *, case when baseline = 0 then 0.0 else abs(current - baseline) / baseline * 100 end as drift_pct
        from raw),
records as (select *, {_SEV} as severity from pct)"""

CHAIN = f"with {SNAP}, {PROFILE}, {BASE}, {VC}, {MEMBERS}, {CBASE}, {RECORDS}"
_DAY = "cast(snapshot_date as varchar) as snapshot_date"
_DRIFT_COLS = f"""{_DAY}, "column", metric, round(baseline, 4) as baseline, round(current, 4) as current,
       round(drift_pct, 4) as drift_pct, severity"""
_LI_LONG = " union all ".join(
    f"""select cast(year(l_shipdate) as int) as snapshot_year, '{c}' as "column", {c} as v from lineitem"""
    for c in _LI_NUM)
_LI_PROFILE = f"""with nums as ({_LI_LONG}),
prof as (select snapshot_year, "column", {_stats_sql('v')} from nums group by 1, 2)
select snapshot_year, "column", count, {_ROUND} from prof"""

QUERIES = {
    "profile_numeric": (profile_numeric, f"""with {SNAP}, {PROFILE}
select {_DAY}, "column", count, {_ROUND} from prof"""),
    "profile_numeric_lineitem": (profile_numeric_lineitem, _LI_PROFILE),
    "profile_numeric_narrowing": (profile_numeric_narrowing, _LI_PROFILE),
    "quantile_selection": (quantile_selection, """
select l_linestatus, l_returnflag, 'l_extendedprice' as "column", i / 10 as prob,
       round(q[i + 1], 4) as value
from (select l_linestatus, l_returnflag, quantile_cont(l_extendedprice,
        [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) as q from lineitem group by 1, 2),
     range(11) as r(i)"""),
    "value_counts": (value_counts, f"""with {SNAP}, {VC}
select {_DAY}, "column", value, n from vc"""),
    "profile_categorical": (profile_categorical, f"""with {SNAP}, {VC}
select {_DAY}, "column", count, cardinality from cprof"""),
    "profile_empty_snapshots": (profile_empty_snapshots, f"""with {SNAP}, {CALENDAR}, {VC},
names as (select unnest({CATEGORICAL}) as "column"),
top as (select snapshot_date, "column", cast(count(*) as int) as top from top5 group by all)
select cast(c.snapshot_date as varchar) as snapshot_date, n."column", coalesce(p.count, 0) as count,
       coalesce(p.cardinality, 0) as cardinality, coalesce(t.top, 0) as top
from calendar c cross join names n
left join cprof p on p.snapshot_date = c.snapshot_date and p."column" = n."column"
left join top t on t.snapshot_date = c.snapshot_date and n."column" = t."column" """),
    "profile_categorical_lineitem": (profile_categorical_lineitem, " union all ".join(
        f"""select cast(year(l_shipdate) as int) as snapshot_year, '{c}' as "column", count({c}) as count,
       count(distinct {c}) as cardinality from lineitem group by 1
""" for c in ("l_returnflag", "l_linestatus", "l_suppkey"))),
    "profile_top5": (profile_top5, f"""with {SNAP}, {VC}
select {_DAY}, "column", value, n from top5"""),
    "profile_top_ranked_documents": (top_values_ranked, """
select * from (
  select lang, 'source' as "column", source as value, count(*) as n,
         cast(row_number() over (partition by lang order by count(*) desc, source) as int) as rank
  from documents group by lang, source) where rank <= 10"""),
    "top_values_bounded": (top_values_bounded, """
with v as (select cast(year(l_shipdate) as int) as snapshot_year, unnest(['l_returnflag', 'l_partkey', 'l_orderkey']) as "column",
                  unnest([l_returnflag, l_partkey::varchar, l_orderkey::varchar]) as value from lineitem),
c as (select snapshot_year, "column", value, count(*) as n from v group by all),
r as (select *, row_number() over (partition by snapshot_year, "column" order by n desc, value)::int as rank from c)
select * from r where rank <= 5"""),
    "profile_missing_columns": (profile_missing_columns, f"""with {SNAP}
select {_DAY}, row_count, c as "column" from (
  select snapshot_date, count(*) as row_count from snap group by 1), unnest(['weight', 'region']) as u(c)"""),
    "baseline_window_members": (baseline_window_members, f"""with {SNAP}, {MEMBERS}
select {_DAY}, cast(member as varchar) as member from members"""),
    "baseline_previous_snapshots": (baseline_previous_snapshots, f"""with {SNAP}
select distinct {_DAY} from snap
where snapshot_date < (select max(snapshot_date) from snap) order by 1 desc limit 7"""),
    "baseline_numeric": (baseline_numeric, f"""with {SNAP}, {PROFILE}, {BASE}
select {_DAY}, "column", {_ROUND}, history_snapshots from base"""),
    "baseline_rolling": (baseline_rolling, f"""with {SNAP}, {PROFILE}, {BASE}
select {_DAY}, "column", {_ROUND}, history_snapshots from base"""),
    "baseline_categorical": (baseline_categorical, f"""with {SNAP}, {VC}, {MEMBERS}, {CBASE}
select {_DAY}, "column", round(avg_cardinality, 4) as avg_cardinality, history_snapshots from cbase"""),
    "baseline_top_values": (baseline_top_values, f"""with {SNAP}, {VC}, {MEMBERS}, {CBASE}
select {_DAY}, "column", value, round(avg_count, 4) as avg_count from tbase"""),
    "baseline_seen_values": (baseline_seen_values, f"""with {SNAP}, {VC}, {MEMBERS}, {CBASE}
select {_DAY}, "column", string_agg(value, ',' order by value) as seen_values from tbase group by 1, 2"""),
    "baseline_last_record": (baseline_last_record, f"""with {SNAP}, {PROFILE},
b3 as (select * from ({_frame(3)}) where history_snapshots > 0),
b7 as (select * from ({_frame(7)}) where history_snapshots > 0)
select {_DAY}, "column", round(mean, 4) as mean, round(median, 4) as median, 1 as run_seq from b3
where "column" <> 'measure'
union all
select {_DAY}, "column", round(mean, 4), round(median, 4), 2 from b7 where "column" = 'measure'"""),
    "baseline_pooled_moments": (baseline_pooled_moments, f"""with {SNAP}, {PROFILE}, {MEMBERS}
select cast(m.snapshot_date as varchar) as snapshot_date, n."column", count(n.v) as rows,
       round(avg(n.v), 4) as pooled_mean, round(stddev_pop(n.v), 4) as pooled_std
from members m join nums n on n.snapshot_date = m.member group by 1, 2"""),
    "window_quantiles": (window_quantiles, f"""with {SNAP}, {PROFILE}, {MEMBERS},
q as (select m.snapshot_date, n."column", count(n.v) as rows, quantile_cont(n.v, [0.25, 0.5, 0.75]) as q
      from members m join nums n on n.snapshot_date = m.member group by 1, 2)
select cast(snapshot_date as varchar) as snapshot_date, "column", i * 0.25::double as prob, rows, round(q[i], 4) as exact, true as within
from q, (values (1), (2), (3)) as t(i)"""),
    "distinct_window": (distinct_window, f"""with {SNAP}, {VC}, {MEMBERS}
select cast(m.snapshot_date as varchar) as snapshot_date, v."column", count(distinct v.value) as exact, true as within
from members m join vc v on v.snapshot_date = m.member group by 1, 2"""),
    "drift_distribution": (drift_distribution, f"""with {SNAP}, {VC}, {MEMBERS},
b as (select m.snapshot_date, v."column", v.value, sum(v.n) as n from members m join vc v on v.snapshot_date = m.member group by all),
t as (select snapshot_date, "column", sum(n) as total from vc group by all),
u as (select snapshot_date, "column", sum(n) as total from b group by all),
j as (select t.snapshot_date, t."column", x.value, coalesce(v.n, 0) / t.total as p, coalesce(b.n, 0) / u.total as q
      from t join u using (snapshot_date, "column")
      join (select snapshot_date, "column", value from vc union select snapshot_date, "column", value from b) x
        using (snapshot_date, "column")
      left join vc v using (snapshot_date, "column", value) left join b using (snapshot_date, "column", value)),
k as (select *, (p + q) / 2 as m, greatest(p, 1e-4) as pf, greatest(q, 1e-4) as qf,
             case when q = 0 then 'new' when p = 0 then 'vanished' end as kind from j),
r as (select *, row_number() over (partition by snapshot_date, "column", kind order by m desc, value) as rank from k),
a as (select snapshot_date, "column",
             round(sqrt(greatest(sum(case when p > 0 then p * log2(p / m) else 0 end + case when q > 0 then q * log2(q / m) else 0 end) / 2, 0)), 4)
               as js_distance,
             sum((pf - qf) * ln(pf / qf)) as raw_psi,
             count(*) filter (kind = 'new') as new_values, count(*) filter (kind = 'vanished') as vanished_values,
             coalesce(string_agg(value, ',' order by rank) filter (kind = 'new' and rank <= 5), '') as new_named,
             coalesce(string_agg(value, ',' order by rank) filter (kind = 'vanished' and rank <= 5), '') as vanished_named
      from r group by 1, 2)
select cast(snapshot_date as varchar) as snapshot_date, "column", js_distance, round(raw_psi, 4) as psi, new_values,
       vanished_values, new_named, vanished_named,
       case when raw_psi >= 0.25 then 'CRITICAL' when raw_psi >= 0.1 then 'WARN' else 'INFO' end as severity from a"""),
    "drift_numeric": (drift_numeric, f"""{CHAIN}
select {_DRIFT_COLS} from records where type = 'numeric'"""),
    "drift_categorical": (drift_categorical, f"""{CHAIN}
select {_DRIFT_COLS} from records where type = 'categorical'"""),
    "drift_records": (drift_records, f"""{CHAIN}
select type, {_DRIFT_COLS} from records"""),
    "drift_severity": (drift_severity, f"""{CHAIN}
select type, "column", severity, count(*) as records from records group by all"""),
    "drift_gate": (drift_gate, f"""{CHAIN}
select {_DAY}, count(*) filter (severity = 'CRITICAL') as critical_records,
       count(*) filter (severity = 'WARN') as warn_records,
       count(*) filter (severity = 'INFO') as info_records,
       case when count(*) filter (severity = 'CRITICAL') > 0 then 'abort' else 'pass' end as action
from records group by snapshot_date"""),
    "drift_bootstrap": (drift_bootstrap, f"""{CHAIN}
select cast(d.snapshot_date as varchar) as snapshot_date, count(r.severity) = 0 as bootstrap,
       count(*) filter (r.severity = 'CRITICAL') as critical_records,
       case when count(*) filter (r.severity = 'CRITICAL') > 0 then 'abort' else 'pass' end as action
from days d left join records r on r.snapshot_date = d.snapshot_date group by d.snapshot_date"""),
}
