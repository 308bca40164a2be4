"""Exact top-k search by tiled matrix products.

Queries are dealt into blocks and candidates into shards, both of bounded size by a hash of the
id; each pair of a block and a shard is a tile, one task's matrix product. A tile gives the k best
of its shard for each query, by partial selection, and the lists are merged in a tree of
``FAN_IN`` shards a level.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from snapgate.llm.common import serve

SCALE = 256
BLOCK_ROWS, SHARD_ROWS, FAN_IN = 4096, 16_384, 16
#: Scores that a task holds at once.
PANEL = 1 << 22
EXACT = float(1 << 53)


def usable(vectors: DataFrame, id_col="vec_id", vector_col="embedding") -> DataFrame:
    """(id, vector, dims): rows whose id and components are there and finite, each once."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & fine).distinct().withColumn("dims", F.size("vector"))


def _matrix(table, dims):
    column = table.column("vector").combine_chunks()
    return np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims))


def _products(a, b):
    """Exact inner products: doubles where no sum can pass 2**53, else Python integers kept in a long."""
    bound = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if bound < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    big = np.dot(whole(a), whole(b).T) if a.size and b.size else np.zeros((len(a), len(b)), object)
    low, high = -(1 << 63), (1 << 63) - 1
    return np.array([[min(high, max(low, x)) for x in row] for row in big], np.int64).reshape(len(a), len(b))


def select(scores, ids, k):
    """Columns of the k best of each row, by score, then smaller id; ``ids`` ascend."""
    if scores.shape[1] <= k:
        return np.ones(scores.shape, bool)
    kth = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k][:, None]
    more, tie = scores > kth, scores == kth
    return more | (tie & (np.cumsum(tie, axis=1) <= k - more.sum(1, keepdims=True)))


def _tile(queries: pa.Table, shard: pa.Table, k: int):
    names = ["query_id", "query", "vec_id", "score"]
    empty = pa.Table.from_arrays([pa.array([], pa.int64())] * 4, names)
    if not queries.num_rows or not shard.num_rows:
        return empty
    dims = queries.column("dims")[0].as_py()
    ids, a, b = shard.column("id").to_numpy(), _matrix(queries, dims), _matrix(shard, dims)
    order = np.argsort(ids, kind="stable")
    ids, b = ids[order], b[order]
    q_ids, q_rows = queries.column("id").to_numpy(), queries.column("query").to_numpy()
    got, step = [], max(k + 1, PANEL // len(a))
    for lo in range(0, len(ids), step):
        mine = ids[lo:lo + step]
        scores = _products(a, b[lo:lo + step])
        own = q_ids[:, None] == mine
        # a query's own rows come after all others, and go
        picked = select(np.where(own, np.iinfo(np.int64).min, scores), mine, k + int(own.sum(1).max(initial=0))) & ~own
        row, column = np.nonzero(picked)
        got.append((row, mine[column], scores[row, column]))
    row, vec, score = (np.concatenate(x) for x in zip(*got, strict=True))
    order = np.lexsort((vec, -score.astype(float), row)) if np.abs(score).max(initial=0) < EXACT else np.lexsort((vec, ~score, row))
    row, vec, score = row[order], vec[order], score[order]
    first = np.searchsorted(row, row)
    top = np.arange(len(row)) - first < k
    return pa.Table.from_arrays([pa.array(x) for x in (q_ids[row[top]], q_rows[row[top]], vec[top], score[top])], names)


def top_k(queries: DataFrame, candidates: DataFrame, k=5, block_rows=BLOCK_ROWS, shard_rows=SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best inner products, both sides as of :func:`usable`.

    Components are ``floor(256 x)``, so scores are whole; ties go to the smaller id. Rows with the
    query's id are its own and no candidates; vectors of another length are none either. A row
    that comes twice counts once; a query without candidates has no rows.
    """
    blocks = max(1, math.ceil(queries.count() / block_rows))
    shards = max(1, math.ceil(candidates.count() / shard_rows))
    spread = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    q = queries.select("id", "vector", "dims", F.xxhash64("vector").alias("query"), F.lit(True).alias("asks"), spread(blocks).alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    c = candidates.select("id", "vector", "dims", F.lit(0).cast("long").alias("query"), F.lit(False).alias("asks"),
                          F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), spread(shards).alias("shard"))

    def tile(key, rows):
        found = _tile(rows.filter(rows.column("asks")), rows.filter(pc.invert(rows.column("asks"))), k)
        return found.append_column("shard", pa.array(np.full(found.num_rows, key[2].as_py(), np.int32)))

    serve(queries.sparkSession)
    tops = q.unionByName(c).groupBy("dims", "block", "shard").applyInArrow(
        tile, "query_id long, query long, vec_id long, score long, shard int")
    while True:
        shards = math.ceil(shards / FAN_IN)
        order = Window.partitionBy("query_id", "query", "shard").orderBy(F.col("score").desc(), "vec_id")
        tops = (tops.withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int"))
                .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
        if shards == 1:
            return tops.select("query_id", "rank", "vec_id", "score")
