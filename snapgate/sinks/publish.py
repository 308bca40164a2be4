"""Publishing by one file that only one writer can create.

Gold and its ledger change together: a load's files are laid beside those they replace, and then
a numbered file names, for every partition, the files that count, and every snapshot that is
processed. That file appears whole or not at all, and of several writers of one number a single
one succeeds. Readers (:func:`read_published`) take what the newest number names, so they see the
table before a load or after it, wherever the load ended; what a dead load left is not named.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

PUBLISHED = "_published"
#: What files of a table that was never published begin with.
PLAIN = "part-"


class TakenError(RuntimeError):
    """Another writer was first."""


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where it does not exist."""
    at, fs = _fs(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str:
    at, fs = _fs(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    at, fs = _fs(spark, path)
    fs.delete(at, False)


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its text at once; False, and nothing changed, where it exists already.

    The text is written under another name first. On a local disk a hard link then gives it its
    own, elsewhere a rename that does not overwrite; neither succeeds twice.
    """
    at, fs = _fs(spark, path)
    jvm = spark._jvm
    fs.mkdirs(at.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_draft-{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    stream.write(text.encode())
    stream.close()
    try:
        if fs.getUri().getScheme() == "file":
            to, source = (jvm.java.io.File(p.toUri().getPath()).toPath() for p in (at, draft))
            jvm.java.nio.file.Files.createLink(to, source)
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
            rename = jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
            options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
            options[0] = jvm.java.lang.Enum.valueOf(rename, "NONE")
            context.rename(draft, at, options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)


@dataclass(frozen=True)
class State:
    """A published table: its number, the start of the counting files' names by partition folder, processed snapshots."""
    number: int = 0
    partitions: dict[str, str] = field(default_factory=dict)
    snapshots: dict[str, str] = field(default_factory=dict)
    replaced: dict[str, str] = field(default_factory=dict)


def head(spark: SparkSession, path: str) -> State:
    """The newest published state; a plain partitioned table without one counts as it is."""
    names = [n for n in listed(spark, f"{path}/{PUBLISHED}") if n.endswith(".json")]
    if names:
        return State(int(names[-1].removesuffix(".json")), **json.loads(read_text(spark, f"{path}/{PUBLISHED}/{names[-1]}")))
    return State(0, {n: PLAIN for n in listed(spark, path) if "=" in n})


def read_published(spark: SparkSession, path: str, schema, state: State | None = None) -> DataFrame:
    """The rows the newest state names; a table that does not exist yet is empty.

    The rows of an older state can be read as long as no later load has replaced them.
    """
    state = state or head(spark, path)
    names = schema.fieldNames() if hasattr(schema, "fieldNames") else None
    if not state.partitions:
        return spark.createDataFrame([], schema)
    files = [f"{path}/{folder}/{start}*" for folder, start in sorted(state.partitions.items())]
    rows = spark.read.schema(schema).option("basePath", path).parquet(*files)
    return rows.select(*names) if names else rows


def publish(rows: DataFrame, path: str, by: str, before: State, snapshots: dict[str, str] | None = None) -> State:
    """Replace the partitions ``rows`` has rows for and add ``snapshots`` to the processed ones, as one.

    ``before`` is the state ``rows`` was made from. Where another writer has published since,
    nothing changes and :class:`TakenError` says so: read the new head and merge again.
    """
    spark, load = rows.sparkSession, uuid.uuid4().hex
    staged = f"{path}/_staged/{load}"
    rows.write.option("compression", "snappy").partitionBy(by).parquet(staged)
    folders = [n for n in listed(spark, staged) if "=" in n]
    _, fs = _fs(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for folder in folders:
        fs.mkdirs(hadoop(f"{path}/{folder}"))
        for name in listed(spark, f"{staged}/{folder}"):
            if not fs.rename(hadoop(f"{staged}/{folder}/{name}"), hadoop(f"{path}/{folder}/{load}-{name}")):
                raise OSError(f"cannot move {staged}/{folder}/{name}")
    fs.delete(hadoop(staged), True)
    after = State(before.number + 1, before.partitions | {f: f"{load}-" for f in folders}, before.snapshots | (snapshots or {}),
                  {f: before.partitions[f] for f in folders if f in before.partitions})
    text = json.dumps({"partitions": after.partitions, "snapshots": after.snapshots, "replaced": after.replaced})
    if not put_if_absent(spark, f"{path}/{PUBLISHED}/{after.number:012d}.json", text):
        _delete(spark, path, {f: f"{load}-" for f in folders})
        raise TakenError(f"another load published number {after.number} of {path}")
    return after


def _delete(spark: SparkSession, path: str, files: dict[str, str]) -> None:
    """Delete the files by the start of their names, partition by partition."""
    _, fs = _fs(spark, path)
    for folder, start in files.items():
        for name in listed(spark, f"{path}/{folder}"):
            if name.startswith(start):
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}/{name}"), False)


def settle(spark: SparkSession, path: str, state: State) -> None:
    """Delete the files a state has replaced, so that the folder also reads right without it. Safe to repeat.

    Only files of the states before are touched, never those of a load on its way. Numbers before
    the newest go too: a reader needs one.
    """
    _delete(spark, path, state.replaced)
    _, fs = _fs(spark, path)
    for name in listed(spark, f"{path}/{PUBLISHED}"):
        if name.endswith(".json") and int(name.removesuffix(".json")) < state.number:
            fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{PUBLISHED}/{name}"), False)


def tidy(spark: SparkSession, path: str) -> None:
    """Delete what dead loads left. Only while no load is running."""
    state = head(spark, path)
    _, fs = _fs(spark, path)
    fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_staged"), True)
    for folder in (n for n in listed(spark, path) if "=" in n):
        for name in listed(spark, f"{path}/{folder}"):
            if not name.startswith(state.partitions.get(folder, "\0")):
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}/{name}"), False)
