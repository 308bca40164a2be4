"""Contract registry rows: newest version, differences, the evolution gate.

A registry is a DataFrame ``(dataset, version, name, type, nullable)``, one row per column.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapgate.config import Contract
from snapgate.functions.text import next_version, version_number

# How a change is described.
REMOVED = "Column removed: "
TYPE_CHANGED = "Type change: "
MADE_REQUIRED = "Nullable → non-nullable: "
MADE_NULLABLE = "Non-nullable → nullable: "
NEW_NULLABLE = "New nullable column: "
NEW_REQUIRED = "New non-nullable column: "

REGISTRY_SCHEMA = "dataset string, version string, name string, type string, nullable boolean"


def contract_rows(spark: SparkSession, dataset: str, contracts: Iterable[Contract]) -> DataFrame:
    rows = [(dataset, c.version, col.name, col.type, col.nullable)
            for c in contracts for col in c.columns]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def latest_versions(registry: DataFrame) -> DataFrame:
    """``(dataset, version)`` with the largest version number of each data set."""
    return registry.groupBy("dataset").agg(
        F.max_by("version", version_number(F.col("version"))).alias("version"))


def latest_contract(registry: DataFrame) -> DataFrame:
    """The registry rows of each data set's newest version."""
    return registry.join(latest_versions(registry), ["dataset", "version"], "left_semi")


def previous_contract(registry: DataFrame) -> DataFrame:
    """The registry rows of the version before the newest one."""
    newest = latest_versions(registry)
    return latest_contract(registry.join(newest, ["dataset", "version"], "left_anti"))


def critical_columns(registry: DataFrame) -> DataFrame:
    """Columns that must not be null; a column without a nullable flag is nullable."""
    return registry.where(~F.coalesce("nullable", F.lit(True)))


def diff_contracts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Every change from ``old`` to ``new`` as ``(dataset, name, kind, change)``.

    ``kind`` is ``breaking``, ``compatible`` or ``relaxed`` (required becomes nullable,
    which neither blocks nor registers). One column can have two changes.
    """
    o = old.select("dataset", "name", F.col("type").alias("o_type"),
                   F.coalesce("nullable", F.lit(True)).alias("o_null"), F.lit(True).alias("o_in"))
    n = new.select("dataset", "name", F.col("type").alias("n_type"),
                   F.coalesce("nullable", F.lit(True)).alias("n_null"), F.lit(True).alias("n_in"))
    name = F.col("name")

    def change(kind, *text):
        return F.struct(F.lit(kind).alias("kind"), F.concat(*text).alias("change"))

    both = F.col("o_in") & F.col("n_in")
    found = F.array_compact(F.array(
        F.when(F.col("n_in").isNull(), change("breaking", F.lit(REMOVED), name)),
        F.when(both & (F.col("o_type") != F.col("n_type")),
               change("breaking", F.lit(TYPE_CHANGED), name, F.lit(" ("), F.col("o_type"),
                      F.lit(" → "), F.col("n_type"), F.lit(")"))),
        F.when(both & F.col("o_null") & ~F.col("n_null"),
               change("breaking", F.lit(MADE_REQUIRED), name)),
        F.when(both & ~F.col("o_null") & F.col("n_null"),
               change("relaxed", F.lit(MADE_NULLABLE), name)),
        F.when(F.col("o_in").isNull() & F.col("n_null"),
               change("compatible", F.lit(NEW_NULLABLE), name)),
        F.when(F.col("o_in").isNull() & ~F.col("n_null"),
               change("breaking", F.lit(NEW_REQUIRED), name)),
    ))
    return (o.join(n, ["dataset", "name"], "full_outer")
            .select("dataset", "name", F.explode(found).alias("c"))
            .select("dataset", "name", "c.kind", "c.change"))


def gate_actions(registered: DataFrame, incoming: DataFrame) -> DataFrame:
    """Per data set: ``abort`` on a breaking change, ``register`` the next version on a
    compatible one, else ``pass``; ``effective_version`` is the version in force afterwards."""
    changes = diff_contracts(registered, incoming).groupBy("dataset").agg(
        F.count_if(F.col("kind") == "breaking").alias("breaking"),
        F.count_if(F.col("kind") == "compatible").alias("compatible"))
    versions = latest_versions(registered)
    breaking, compatible = F.coalesce("breaking", F.lit(0)), F.coalesce("compatible", F.lit(0))
    action = (F.when(breaking > 0, "abort").when(compatible > 0, "register").otherwise("pass"))
    return (versions.join(changes, "dataset", "left")
            .select("dataset", F.col("version").alias("registered_version"),
                    breaking.alias("breaking"), compatible.alias("compatible"),
                    action.alias("action"))
            .withColumn("effective_version",
                        F.when(F.col("action") == "register", next_version(F.col("registered_version")))
                        .otherwise(F.col("registered_version"))))


def rows_to_register(registered: DataFrame, incoming: DataFrame) -> DataFrame:
    """The incoming contract under its new version, for data sets whose gate says register."""
    todo = (gate_actions(registered, incoming).where("action = 'register'")
            .select("dataset", F.col("effective_version").alias("version")))
    return (incoming.drop("version").join(todo, "dataset")
            .select("dataset", "version", "name", "type", "nullable"))
