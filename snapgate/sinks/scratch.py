"""Intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

def scratch_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which driver and executors must share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return f"{root.rstrip('/')}/snapgate-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` and go on from the stored rows.

    Lost executors then repeat nothing before this point, and the planner knows the real
    size of what follows, so it broadcasts only what it has measured to be small. The table goes when Spark ends.
    """
    path = scratch_dir(df.sparkSession)
    df.write.parquet(path)
    at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(at)
    return df.sparkSession.read.schema(df.schema).parquet(path)
