"""Quality rules over rows: predicates, unique keys and references to other tables.

All rules of a table are one aggregate over one scan. Each row gives each rule a key: whether it
holds, the unique key's values, or the referenced ones. Counting rows by snapshot, rule and key is
partially aggregated, so a key that a third of all rows share is one row of each task; whether a
key breaks its rule is then decided once for each key, not for each row. A reference is a semi
join of the distinct keys, in front of which Spark puts its own Bloom filter where sizes call for
one.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from snapgate.sinks.scratch import cut_lineage


@dataclass(frozen=True)
class Holds:
    """A condition every row must meet, as a column or SQL text; an unknown one is met, unless ``strict``."""
    name: str
    condition: Column | str
    strict: bool = False
    limit_pct: float = 0.0


@dataclass(frozen=True)
class Unique:
    """Columns no two rows of a snapshot share; all rows of a repeated key break it, rows with a NULL do not."""
    name: str
    columns: tuple[str, ...]
    limit_pct: float = 0.0


@dataclass(frozen=True)
class References:
    """Columns whose values another table has, in ``there`` by order; rows with a NULL do not break it."""
    name: str
    columns: tuple[str, ...]
    table: DataFrame
    there: tuple[str, ...]
    limit_pct: float = 0.0


Rule = Holds | Unique | References
BROKEN = "false"


def _key(columns: Sequence[str]) -> Column:
    """The columns' values as one text; NULL when one is."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return F.when(known, F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])))


def _rule_key(rule: Rule) -> Column:
    if isinstance(rule, Holds):
        condition = F.expr(rule.condition) if isinstance(rule.condition, str) else rule.condition
        return F.coalesce(condition, F.lit(not rule.strict)).cast("string")
    return _key(rule.columns)


def key_counts(df: DataFrame, rules: Sequence[Rule], by: str = "snapshot_date") -> DataFrame:
    """``(by, rule, key, n)`` of all rules in one pass over ``df``; a row that does not count has a NULL key."""
    names = [r.name for r in rules]
    if len({*names}) < len(names):
        raise ValueError(f"rules with one name: {names}")
    keys = F.array(*[F.struct(F.lit(r.name).alias("rule"), _rule_key(r).alias("key")) for r in rules])
    return df.select(by, F.inline(keys)).groupBy(by, "rule", "key").agg(F.count("*").alias("n"))


def broken_keys(counts: DataFrame, rules: Sequence[Rule], by: str = "snapshot_date") -> DataFrame:
    """The rows of a stored :func:`key_counts` whose key breaks its rule."""
    holds = [r.name for r in rules if isinstance(r, Holds)]
    unique = [r.name for r in rules if isinstance(r, Unique)]
    rule = F.col("rule")
    broken = counts.where((rule.isin(holds) & (F.col("key") == BROKEN)) | (rule.isin(unique) & F.col("key").isNotNull() & (F.col("n") > 1)))
    references = [r for r in rules if isinstance(r, References)]
    if not references:
        return broken
    known = reduce(DataFrame.unionByName, [
        r.table.select(F.lit(r.name).alias("rule"), _key(r.there).alias("key")).where("key is not null") for r in references])
    asked = counts.where(rule.isin([r.name for r in references]) & F.col("key").isNotNull())
    keys = asked.select("rule", "key").distinct()
    # of the distinct keys most are known: what the semi join finds is taken off, the rest is broken
    found = keys.join(known, ["rule", "key"], "left_semi").withColumn("known", F.lit(True))
    missing = asked.join(found, ["rule", "key"], "left").where("known is null").drop("known")
    return broken.unionByName(missing.select(*counts.columns))


def check_rows(df: DataFrame, rules: Sequence[Rule], by: str = "snapshot_date") -> DataFrame:
    """``(by, rule, row_count, violations, violated_pct, status)`` for every snapshot with rows and every rule."""
    counts = cut_lineage(key_counts(df, rules, by))
    return judge(counts, broken_keys(counts, rules, by), rules, by)


def judge(counts: DataFrame, broken: DataFrame, rules: Sequence[Rule], by: str = "snapshot_date") -> DataFrame:
    """The verdict of :func:`check_rows` from counts and broken keys; a rule fails above its ``limit_pct``."""
    both = counts.select(by, "rule", F.col("n").alias("rows"), F.lit(0).cast("bigint").alias("bad")).unionByName(
        broken.select(by, "rule", F.lit(0).cast("bigint").alias("rows"), F.col("n").alias("bad")))
    total = both.groupBy(by, "rule").agg(F.sum("rows").alias("row_count"), F.sum("bad").alias("violations"))
    limit = F.create_map(*[F.lit(x) for r in rules for x in (r.name, float(r.limit_pct))])[F.col("rule")]
    pct = F.col("violations") / F.col("row_count") * 100
    return total.withColumn("violated_pct", pct).withColumn("status", F.when(F.col("violated_pct") > limit, "FAILED").otherwise("PASSED"))


def violating_rows(df: DataFrame, rules: Sequence[Rule], broken: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """The rows that break a rule, as they are, with the rules' names in ``_violations``.

    ``broken`` is a stored :func:`broken_keys`; Spark broadcasts it where its size allows, and a
    rule without broken keys costs no join.
    """
    found = {r[0] for r in broken.select("rule").distinct().collect()}
    marks, rows = [], df
    for i, rule in enumerate(r for r in rules if r.name in found):
        if isinstance(rule, Holds):
            marks.append(F.when(_rule_key(rule) == BROKEN, F.lit(rule.name)))
            continue
        keys = broken.where(F.col("rule") == rule.name).select(F.col(by).alias(f"_by{i}"), F.col("key").alias(f"_key{i}"))
        rows = rows.join(keys, F.col(by).eqNullSafe(F.col(f"_by{i}")) & (_key(rule.columns) == F.col(f"_key{i}")), "left")
        marks.append(F.when(F.col(f"_key{i}").isNotNull(), F.lit(rule.name)))
    if not marks:
        return df.withColumn("_violations", F.array().cast("array<string>")).limit(0)
    return rows.withColumn("_violations", F.array_compact(F.array(*marks))).where(F.size("_violations") > 0).select(*df.columns, "_violations")
