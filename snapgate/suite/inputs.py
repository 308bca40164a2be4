"""The given tables shaped as snapshots, in Spark and as SQL for the oracle.

``snap`` is the event stream as daily snapshots. The tables hold no nulls, so missing and
malformed cells are put in by rule; every row of the table is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from snapgate.config import Contract, ContractColumn, QualityLimits

SNAP_KEYS = ["entity_id", "period", "category", "snapshot_date"]
NUMERIC = ["measure", "amount"]
CATEGORICAL = ["category", "period", "entity_id"]

CONTRACT = Contract("v1", (
    ContractColumn("entity_id", "integer", False),
    ContractColumn("category", "string", False),
    ContractColumn("period", "string", False),
    ContractColumn("measure", "integer", False),
    ContractColumn("snapshot_date", "date", False),
))
TEXT_CONTRACT = Contract("v2", (
    ContractColumn("category", "string", False),
    ContractColumn("period", "string", False),
    ContractColumn("measure_text", "integer", False),
    ContractColumn("date_text", "date", False),
))
LIMITS = QualityLimits(5.0, 1.0, ("entity_id", "category"))


# The schemas of the given tables, so that reading them infers nothing.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def snap(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eid, value = F.col("event_id"), F.col("value")
    whole = value.cast("bigint")
    return e.select(
        eid.alias("src_pos"),
        F.col("ts").cast("date").alias("snapshot_date"),
        F.when(eid % 101 != 0, F.col("user_id")).alias("entity_id"),
        F.col("event_type").alias("category"),
        F.concat(F.lit("Q"), F.floor(F.hour("ts") / 6).cast("string")).alias("period"),
        F.when(eid % 37 == 0, F.lit(None)).when(eid % 41 == 0, F.lit(float("nan")))
        .otherwise(value).alias("measure"),
        F.when(eid % 43 != 0, whole).alias("amount"),
        F.when(eid % 211 == 0, "NA").when(eid % 307 == 0, "12.5").when(eid % 503 == 0, "abc")
        .otherwise(whole.cast("string")).alias("measure_text"),
        F.date_format("ts", "yyyy-MM-dd").alias("date_text"),
    )


SNAP = """snap as (
  select event_id as src_pos, cast(ts as date) as snapshot_date,
         case when event_id % 101 <> 0 then user_id end as entity_id,
         event_type as category,
         'Q' || cast(hour(ts) // 6 as varchar) as period,
         case when event_id % 37 = 0 then null
              when event_id % 41 = 0 then cast('NaN' as double) else value end as measure,
         case when event_id % 43 <> 0 then cast(trunc(value) as bigint) end as amount,
         case when event_id % 211 = 0 then 'NA' when event_id % 307 = 0 then '12.5'
              when event_id % 503 = 0 then 'abc'
              else cast(cast(trunc(value) as bigint) as varchar) end as measure_text,
         strftime(ts, '%Y-%m-%d') as date_text
  from events)"""

CLEAN = """kept as (
  select * from snap
  where entity_id is not null and measure is not null and not isnan(measure)),
firsts as (
  select * from (select *, row_number() over (
      partition by entity_id, period, category, snapshot_date order by src_pos) as rn from kept)
  where rn = 1)"""


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day from two before the first event to three after the last."""
    days = table(spark, sf_dir, "events").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    span = F.sequence(F.date_sub(F.col("a").cast("date"), 2), F.date_add(F.col("b").cast("date"), 3))
    return days.select(F.explode(span).alias("snapshot_date"))


CALENDAR = """calendar as (
  select cast(unnest(generate_series(cast(min(ts) as date) - 2, cast(max(ts) as date) + 3,
                                     interval 1 day)) as date) as snapshot_date
  from events)"""


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A contract registry read off the parts: a brand's parts of a size class are the columns
    of one version; a column declared again keeps its last declaration."""
    p = table(spark, sf_dir, "part")
    word = F.split("p_name", " ")[0]
    rows = p.select(
        F.col("p_brand").alias("dataset"),
        F.concat(F.lit("v"), (F.floor((F.col("p_size") - 1) / 5) + 1).cast("string")).alias("version"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("name"),
        F.struct("p_partkey", _contract_type("p_type").alias("type"),
                 F.when(word.isin("small", "hot"), F.lit(None))
                 .otherwise(~word.isin("red", "blue")).alias("nullable")).alias("d"))
    return (rows.groupBy("dataset", "version", "name")
            .agg(F.max_by("d", "d.p_partkey").alias("d"))
            .select("dataset", "version", "name", "d.type", "d.nullable"))


def _contract_type(col: str):
    c = F.col(col)
    return (F.when(c.isin("ECONOMY", "SMALL"), "integer").when(c.isin("LARGE", "MEDIUM"), "date")
            .otherwise("string"))


_TYPE_SQL = """case when p_type in ('ECONOMY', 'SMALL') then 'integer'
              when p_type in ('LARGE', 'MEDIUM') then 'date' else 'string' end"""

REGISTRY = f"""registry as (
  select * exclude (p_partkey, rn) from (
    select *, row_number() over (partition by dataset, version, name order by p_partkey desc) as rn
    from (select p_partkey, p_brand as dataset,
                 'v' || cast((p_size - 1) // 5 + 1 as varchar) as version,
                 replace(p_name, ' ', '_') as name, {_TYPE_SQL} as type,
                 case when split_part(p_name, ' ', 1) in ('small', 'hot') then null
                      else split_part(p_name, ' ', 1) not in ('red', 'blue') end as nullable
          from part)) where rn = 1),
numbered as (
  select *, dense_rank() over (partition by dataset order by cast(substr(version, 2) as int) desc) as age
  from registry),
newest as (select dataset, version, name, type, nullable from numbered where age = 1),
before as (select dataset, version, name, type, nullable from numbered where age = 2)"""


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns each brand delivered per month: its parts shipped then, with their type."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"),
        F.trunc(F.col("l_shipdate").cast("date"), "month").alias("snapshot_date"))
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("dataset"),
        F.replace("p_name", F.lit(" "), F.lit("_")).alias("name"), _contract_type("p_type").alias("type"))
    # few part numbers are sold often, so lines collapse to (month, part) ahead of the join
    sold = lines.distinct()
    return (sold.join(parts, "p_partkey").groupBy("snapshot_date", "dataset", "name")
            .agg(F.max("type").alias("type")))


DELIVERED = f"""delivered as (
  select cast(date_trunc('month', l_shipdate) as date) as snapshot_date, p_brand as dataset,
         replace(p_name, ' ', '_') as name, max({_TYPE_SQL}) as type
  from lineitem join part on l_partkey = p_partkey group by all),
expected as (
  select d.snapshot_date, n.dataset, n.version, n.name, n.type
  from (select distinct snapshot_date, dataset from delivered) d
  join (select distinct dataset, version, name, type from newest) n on d.dataset = n.dataset)"""


def yearly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as yearly snapshots in order of their key."""
    return table(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").alias("snapshot_year"), "o_orderkey", "o_orderstatus",
        "o_orderpriority", "o_totalprice")


def out(df: DataFrame) -> DataFrame:
    """Dates and timestamps as ISO text, so both engines hash the same values."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)
