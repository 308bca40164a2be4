"""What the operators share: Arrow text as flat arrays, bounded chunks, stored tables, components."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Bytes of text a task works on at once; a longer document is a chunk of its own.
CHUNK_BYTES = 2 << 20

#: True for bytes that end a word: space and U+0009 to U+000D.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(MULTIPLIER), -1, 1 << 64))
#: A random value for each byte, of a fixed seed.
BYTE_VALUES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, whatever its letters' case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def keep(df: DataFrame) -> DataFrame:
    """``df`` as a table in the folder ``spark.checkpoint.dir`` names, gone when Spark ends.

    Lost executors then repeat nothing before it and the planner knows its size.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._at = at
    return kept


def forget(kept: DataFrame) -> None:
    """Delete a table of :func:`keep` that nothing will read again."""
    kept._at.getFileSystem(kept.sparkSession._jsc.hadoopConfiguration()).delete(kept._at, True)


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins, with the end; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, pa.scalar("" if pa.types.is_string(column.type) else b"", column.type))
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(batches, text: str, limit: int = CHUNK_BYTES):
    """Slices of the batches with at most ``limit`` bytes of text, a longer row alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(size), 0
        while start < len(size):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def serve(spark: SparkSession) -> None:
    """Let the driver serve this package to the workers, as a zip file, once."""
    sc = spark.sparkContext
    if getattr(sc, "_snapgate_served", None) is None:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        packed = io.BytesIO()
        with zipfile.ZipFile(packed, "w") as z:
            for folder, _, files in os.walk(top):
                for name in sorted(f for f in files if f.endswith(".py")):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
        path = os.path.join(tempfile.mkdtemp(prefix="code-"), "snapgate.zip")
        with open(path, "wb") as f:
            f.write(packed.getvalue())
        sc.addPyFile(path)
        sc._snapgate_served = path


def in_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` by workers that have this package."""
    serve(df.sparkSession)
    return df.mapInArrow(fn, schema)


def map_chunks(df: DataFrame, text: str, schema: str, fn, limit: int = CHUNK_BYTES) -> DataFrame:
    """``fn(batch) -> batch`` over bounded slices."""
    def run(batches):
        for piece in chunks(batches, text, limit):
            yield fn(piece)
    return in_arrow(df, run, schema)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of each maximal run of True that stays in a document."""
    n = len(inside)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    begins = offsets[:-1]
    before[begins[begins < n]] = False
    lasts = offsets[1:] - 1
    after[lasts[lasts >= 0]] = False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, for 0 to n."""
    if not _powers or len(_powers["up"]) <= n:
        size = max(n + 1, CHUNK_BYTES + (1 << 16))
        for name, base in (("up", MULTIPLIER), ("down", INVERSE)):
            values = np.full(size, base, np.uint64)
            values[0] = 1
            _powers[name] = np.cumprod(values)
    return _powers["up"], _powers["down"]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums whose differences, times a power of the inverse, are hashes of substrings."""
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[:len(data)], out=sums[1:])
    return sums


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each substring and its length."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _edges(df: DataFrame, a, b) -> DataFrame:
    return (df.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
            .where("u <> v").distinct())


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for each linked node, root being the smallest node reachable.

    ``links`` has the columns a and b (long). Large and small stars alternate until nothing
    changes; a star is a minimum per node and a join, so a hub is never gathered in one place,
    and each round is a stored table.
    """
    edges, seen = keep(_edges(links, F.col("a"), F.col("b"))), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1000000007)).first()
        if state == seen or not state[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = _edges(both.where("v > u").join(least, "u"), F.col("v"), F.col("m"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        last, edges = edges, keep(_edges(small.select(F.col("v").alias("u"), "m").unionByName(small.select("u", "m")),
                            F.col("u"), F.col("m")))
        forget(last)
