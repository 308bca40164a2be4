"""Layer and metric writers."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapgate.operators import gold
from snapgate.operators.contracts import REGISTRY_SCHEMA
from snapgate.sinks.publish import (TakenError, head, listed, publish, put_if_absent, read_published, read_text,
                                    settle)
from snapgate.sources.raw import SNAPSHOT
from snapgate.sources.snapshots import path_exists

#: Registrations as they are claimed, a file for each version.
CLAIMS = "_claims"


def write_layer(df: DataFrame, path: str, file_format: str = "parquet", by: str = SNAPSHOT,
                rebalance: bool = False, append: bool = False) -> None:
    """Replace the partitions ``df`` has rows for, or with ``append`` add to them, and leave the others alone.

    Only dynamic mode is ever used: static mode would delete partitions that are being read.
    With ``rebalance`` rows are first gathered by snapshot into files of the advisory size;
    a very large snapshot is split over many tasks. Use it after a shuffle on row keys.
    """
    if rebalance:
        df = df.hint("rebalance", by)
    writer = df.write.mode("append" if append else "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by)
    if file_format == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    else:
        writer.option("compression", "snappy").parquet(path)


def write_empty(df: DataFrame, path: str, snapshots: Sequence[str], file_format: str = "parquet",
                by: str = SNAPSHOT) -> None:
    """Make the snapshots' partitions empty files, so that they exist but have no rows.

    One job writes one empty file, which is copied to each partition in place of what lies there.
    """
    if not snapshots:
        return
    spark, staged = df.sparkSession, f"{path}/_empty-{uuid.uuid4().hex}"
    none = df.drop(by).limit(0).coalesce(1)
    none.write.mode("overwrite").format(file_format).option("header", True).save(staged)
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    fs = hadoop.Path(staged).getFileSystem(conf)
    names = [n for n in listed(spark, staged) if not n.startswith(("_", "."))]
    for s in snapshots:
        to = hadoop.Path(f"{path}/{by}={s}")
        fs.delete(to, True)
        fs.mkdirs(to)
        for name in names:
            hadoop.FileUtil.copy(fs, hadoop.Path(f"{staged}/{name}"), fs, hadoop.Path(to, name), False, conf)
    fs.delete(hadoop.Path(staged), True)


def append_metrics(df: DataFrame, path: str, run_seq: int, run_ts: str, by: str = SNAPSHOT) -> None:
    """Add records to a metric history as JSON lines, one folder per snapshot.

    ``run_seq`` grows with every run and orders the records of a snapshot that ran again.
    """
    stamped = df.withColumns({"run_seq": F.lit(run_seq).cast("bigint"), "timestamp": F.lit(run_ts)})
    stamped.write.mode("append").partitionBy(by).json(path)


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A plain Parquet table; one that does not exist yet is empty."""
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def read_gold(spark: SparkSession, path: str, schema) -> DataFrame:
    """The gold table as last published; one that does not exist yet is empty."""
    return read_published(spark, path, schema)


def write_gold(source: DataFrame, target: DataFrame, path: str, keys: Sequence[str],
               order: Sequence[str], by: str) -> None:
    """Merge ``source`` into the partitioned gold table at ``path`` and publish it. Safe to repeat.

    ``target`` is the table restricted to the partitions the source touches
    (:func:`gold.touched`); exactly those are replaced, and its columns are kept.
    """
    spark = source.sparkSession
    state = head(spark, path)
    rows = gold.upsert(target, source, keys, order).hint("rebalance", by)
    settle(spark, path, publish(rows, path, by, state))


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """Every registered contract column; a registration counts from the moment it is claimed."""
    rows = read_table(spark, path, REGISTRY_SCHEMA)
    claims = [f"{path}/{CLAIMS}/{d}/*.json" for d in listed(spark, f"{path}/{CLAIMS}")]
    return rows.unionByName(spark.read.schema(REGISTRY_SCHEMA).json(claims)).distinct() if claims else rows


def register_versions(rows: DataFrame, path: str) -> None:
    """Register the contracts ``rows`` holds under their versions, each in one step.

    Of several writers of one version one wins: its claim is a file that is created once. The others
    look at what is registered; a contract other than theirs raises :class:`TakenError`, after
    the contracts of this call that nobody else claimed are registered.
    """
    spark, lost = rows.sparkSession, []
    contracts_of: dict[tuple[str, str], list[dict]] = {}
    for r in rows.select("dataset", "version", "name", "type", "nullable").collect():   # a row for each column
        contracts_of.setdefault((r["dataset"], r["version"]), []).append(r.asDict())
    known = {}
    for r in read_table(spark, path, REGISTRY_SCHEMA).join(rows.select("dataset", "version").distinct(), ["dataset", "version"], "left_semi").collect():
        known.setdefault((r["dataset"], r["version"]), []).append(r.asDict())
    won = []
    for (dataset, version), columns in sorted(contracts_of.items()):
        text, there = _as_lines(columns), known.get((dataset, version))
        file = f"{path}/{CLAIMS}/{quote(dataset, safe='')}/{version}.json"
        if there is None and put_if_absent(spark, file, text):
            won += columns
        elif (_as_lines(there) if there else read_text(spark, file)) != text:
            lost.append(f"{dataset} {version}")
    if won:
        spark.createDataFrame([tuple(c.values()) for c in won], REGISTRY_SCHEMA).coalesce(1).write.mode("append").parquet(path)
    if lost:
        raise TakenError(f"registered by others with another contract: {lost}")


def _as_lines(columns: list[dict]) -> str:
    return "\n".join(json.dumps(c, sort_keys=True) for c in sorted(columns, key=lambda c: c["name"]))
