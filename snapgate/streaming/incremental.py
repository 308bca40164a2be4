"""Run the jobs for raw files that arrived since the last call.

A file stream over the raw folder finds the new files; its checkpoint remembers them. Files
are only listed here, the jobs read them. A batch whose gate refuses is tried again by the
next call; everything it repeats is idempotent.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from snapgate.config import DatasetConfig
from snapgate.plans.jobs import Run, run_all
from snapgate.sources.raw import SNAPSHOT

LISTING = (f"path string, modificationTime timestamp, length bigint, content binary, "
           f"{SNAPSHOT} string")


def run_new_snapshots(spark: SparkSession, cfg: DatasetConfig, root: str, checkpoint: str,
                      run_ts: str, first_seq: int = 1,
                      job: Callable[[SparkSession, DatasetConfig, Run, Sequence[str]], None] = run_all
                      ) -> None:
    """Process every snapshot with new raw files, then return.

    ``first_seq`` must exceed the sequence numbers of runs started by other means.
    """
    files = spark.readStream.format("binaryFile").schema(LISTING).load(f"{root.rstrip('/')}/raw")

    def batch(new: DataFrame, batch_id: int) -> None:
        snapshots = [r[0] for r in new.select(SNAPSHOT).distinct().orderBy(SNAPSHOT).collect()]
        if snapshots:
            job(spark, cfg, Run(root, run_ts, first_seq + batch_id), snapshots)

    query = (files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
