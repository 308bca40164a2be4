"""SimHash near-duplicates by a self-join of binary tries.

Fingerprints that differ in at most three of 64 bits agree in at least one of four 16-bit
blocks. Each distinct fingerprint is rotated so that a block stands on top, once for each block,
and the 65,536 subtrees under a block are spread over the tasks. Within a task node pairs of the
tries are traversed together from (subtree, itself) downwards; differing bits add up and a pair
beyond the budget goes. A subtree with more than ``hot`` fingerprints is split by six more bits
into the pairs of its 64 nodes that are within the budget.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from snapgate.llm.common import SPACE, components, flat, fresh, in_arrow, keep, map_chunks, runs

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
HOT_SUBTREE = 200_000
BLOCK_BITS, SPLIT_BITS = 16, 6
#: Node pairs that are expanded at once.
STEP = 1 << 18


def _normal(data, offsets):
    """Words of the lower-cased texts with one space between, where they begin and end, and their text."""
    data = data.copy()
    data[(data >= 65) & (data <= 90)] += 32
    space = SPACE[data]
    data[space] = 32
    starts, ends, doc = runs(~space, offsets)
    stay = ~space
    stay[ends[ends < len(data)]] = True
    place = np.zeros(len(data) + 1, np.int64)
    np.cumsum(stay, out=place[1:])
    return data[stay].tobytes(), place[starts], place[ends], doc


def fingerprints(data, offsets, width=SHINGLE_WORDS):
    """SimHash of each text as unsigned integers."""
    text, starts, ends, doc = _normal(data, offsets)
    n = len(offsets) - 1
    words = np.bincount(doc, minlength=n)
    first = np.cumsum(words) - words
    per_doc = np.where(words, np.maximum(words - width + 1, 1), 0)
    owner = np.repeat(np.arange(n), per_doc)
    begin = np.cumsum(per_doc) - per_doc
    at = first[owner] + np.arange(len(owner)) - begin[owner]
    last = np.minimum(at + width, first[owner] + words[owner]) - 1
    pieces = (text[a:b] for a, b in zip(starts[at].tolist(), ends[last].tolist(), strict=True))
    h = np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(owner))
    out = np.zeros(n, np.uint64)
    full = np.flatnonzero(per_doc)
    if len(full):
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, begin[full], axis=0, dtype=np.int32)
        major = np.packbits(2 * ones > per_doc[full, None], axis=1, bitorder="little")
        out[full] = major.view("<u8")[:, 0]
    return out


def with_fingerprint(docs: DataFrame, text_col="text", out="fingerprint", width=SHINGLE_WORDS) -> DataFrame:
    """All columns and the fingerprint as a signed long; a null text is empty."""
    schema = docs.select("*", F.lit(0).cast("long").alias(out)).schema

    def run(batch):
        fp = fingerprints(*flat(batch.column(text_col)), width).view(np.int64)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(fp)], [*batch.schema.names, out])

    return map_chunks(docs, text_col, schema, run)


def _unite(comp, a, b):
    """Component labels after linking a with b: the smallest index of each component."""
    while True:
        ra, rb = comp[a], comp[b]
        open_ = ra != rb
        if not open_.any():
            return comp
        a, b, low = a[open_], b[open_], np.minimum(ra, rb)[open_]
        comp = comp.copy()
        np.minimum.at(comp, ra[open_], low)
        np.minimum.at(comp, rb[open_], low)
        while (jump := comp[comp]).tobytes() != comp.tobytes():
            comp = jump


def _mid(v, lo, hi, depth):
    """Where the second child of nodes at a depth begins."""
    low = np.uint64(64 - depth)
    key = ((v[lo] >> low) << low if depth else np.zeros(len(lo), np.uint64)) | (np.uint64(1) << np.uint64(63 - depth))
    return np.clip(np.searchsorted(v, key), lo, hi)


def traverse(v, comp, roots, depth, budget, step=STEP):
    """Labels after linking all leaves of node pairs that differ in at most ``budget`` bits.

    v: sorted distinct fingerprints, the leaves; roots: arrays (a0, a1, b0, b1, diff) of node
    pairs as ranges of leaves, a node with itself or disjoint ones. A pair whose leaves already
    are in one component goes too; only the components matter.
    """
    stack, change, of = [(depth, *roots)], None, None
    while stack:
        depth, a0, a1, b0, b1, diff = stack.pop()
        if len(a0) > step:
            half = len(a0) // 2
            stack += [(depth, *(x[:half] for x in (a0, a1, b0, b1, diff))), (depth, *(x[half:] for x in (a0, a1, b0, b1, diff)))]
            continue
        if of is not comp:
            change, of = np.concatenate([[0], np.cumsum(comp[1:] != comp[:-1])]), comp
        joined = (change[a1 - 1] == change[a0]) & (change[b1 - 1] == change[b0]) & (comp[a0] == comp[b0])
        a0, a1, b0, b1, diff = (x[~joined] for x in (a0, a1, b0, b1, diff))
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1)
        near = leaf.copy()
        near[leaf] = np.bitwise_count(v[a0[leaf]] ^ v[b0[leaf]]) <= budget
        if near.any():
            comp = _unite(comp, a0[near], b0[near])
        a0, a1, b0, b1, diff = (x[~leaf] for x in (a0, a1, b0, b1, diff))
        if not len(a0):
            continue
        am, bm, other = _mid(v, a0, a1, depth), _mid(v, b0, b1, depth), a0 != b0
        pairs = [np.concatenate(x) for x in zip(
            (a0, am, b0, bm, diff), (am, a1, bm, b1, diff), (a0, am, bm, b1, diff + 1),
            tuple(x[other] for x in (am, a1, b0, bm, diff + 1)), strict=True)]
        a0, a1, b0, b1, diff = pairs
        live = (a1 > a0) & (b1 > b0) & (diff <= budget) & ~((a0 == b0) & (a1 - a0 == 1))
        stack.append((depth + 1, *(x[live] for x in pairs)))
    return comp


def _ranges(top):
    """Starts and ends of runs of equal values."""
    cut = np.flatnonzero(np.concatenate([[True], top[1:] != top[:-1]]))
    return cut, np.append(cut[1:], len(top))


def _forest(v, pair, budget):
    """For leaves of one rotation, or of one node pair of a split subtree, each leaf's root."""
    v = np.sort(v)
    comp = np.arange(len(v))
    if pair < 0:
        lo, hi = _ranges(v >> np.uint64(64 - BLOCK_BITS))
        depth, roots = BLOCK_BITS, (lo, hi, lo, hi, np.zeros(len(lo), np.int64))
    else:
        depth = BLOCK_BITS + SPLIT_BITS
        p, q = divmod(pair, 1 << SPLIT_BITS)
        top = v >> np.uint64(64 - depth)
        tops, lo, hi = np.unique(top >> np.uint64(SPLIT_BITS)), [], []
        for wanted in (p, q):
            keys = (tops << np.uint64(SPLIT_BITS)) | np.uint64(wanted)
            lo.append(np.searchsorted(top, keys, "left"))
            hi.append(np.searchsorted(top, keys, "right"))
        full = (hi[0] > lo[0]) & (hi[1] > lo[1])
        roots = [x[full] for x in (lo[0], hi[0], lo[1], hi[1])] + [np.full(int(full.sum()), (p ^ q).bit_count(), np.int64)]
    for bits in sorted({min(1, budget), budget}):
        if len(roots[0]) and int(roots[4].min()) <= bits:
            allowed = roots[4] <= bits
            comp = traverse(v, comp, tuple(x[allowed] for x in roots), depth, bits)
    moved = np.flatnonzero(comp != np.arange(len(v)))
    return v[moved], v[comp[moved]]


def _turn(v, bits):
    """Rotated to the left."""
    bits %= 64
    return v if not bits else (v << np.uint64(bits)) | (v >> np.uint64(64 - bits))


def links(prints: DataFrame, budget=MAX_BITS, hot=HOT_SUBTREE) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that span all components of the link relation."""
    if not 0 <= budget <= 3:
        raise ValueError("four blocks find differences of up to three bits")
    turned = prints.select(F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"), "fingerprint").select(
        "k", F.expr("shiftleft(fingerprint, 16 * k) | if(k = 0, 0L, shiftrightunsigned(fingerprint, 64 - 16 * k))").alias("v")
    ).withColumn("block", F.expr("shiftrightunsigned(v, 48)"))
    turned = keep(turned)
    large = turned.groupBy("k", "block").count().where(F.col("count") > hot).select("k", "block", F.lit(True).alias("large"))
    node = "shiftrightunsigned(v, 42) & 63"
    dealt = turned.join(large, ["k", "block"], "left").select("k", "block", "v", F.explode(F.expr(
        f"if(large, transform(filter(sequence(0L, 63L), q -> bit_count(({node}) ^ q) <= {budget}), "
        f"q -> cast(least({node}, q) * 64 + greatest({node}, q) as int)), array(-1))")).alias("pair"))

    def run(batches):
        got = [(b.column("k").to_numpy(), b.column("v").to_numpy(), b.column("pair").to_numpy()) for b in batches if b.num_rows]
        if not got:
            return
        k, v, pair = (np.concatenate(x) for x in zip(*got, strict=True))
        code = k.astype(np.int64) * (1 << 13) + pair + 1
        order = np.argsort(code, kind="stable")
        for lo, hi in zip(*_ranges(code[order]), strict=True):
            mine = order[lo:hi]
            a, b = _forest(v[mine].view(np.uint64), int(pair[mine[0]]), budget)
            back = 64 - BLOCK_BITS * int(k[mine[0]])
            yield pa.RecordBatch.from_arrays([pa.array(_turn(x, back).view(np.int64)) for x in (a, b)], ["a", "b"])

    return in_arrow(dealt.repartition("k", "block", "pair"), run, "a long, b long")


def near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", width=SHINGLE_WORDS, budget=MAX_BITS) -> DataFrame:
    """(id, fingerprint long, component_id) of each row.

    component_id is the smallest id reachable over links, null only where all reachable ids are
    null. Repeated rows come out repeated; an empty table gives an empty result.
    """
    found = keep(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), width=width)
                 .select("id", "fingerprint"))
    prints = keep(found.groupBy("fingerprint").agg(F.min("id").alias("least")))
    roots = components(links(prints.select("fingerprint"), budget))
    classes = prints.join(roots, prints.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    classes = keep(classes)
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(least, "root").select("fingerprint", "component_id")
    return found.join(named, "fingerprint").select(F.col("id").alias(id_col), "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col="doc_id", text_col="text", width=SHINGLE_WORDS, budget=MAX_BITS) -> DataFrame:
    """One row of each component stays: the smallest id, ties by the row's hash; a null id comes last."""
    fp, root, place, row = fresh(docs, "fingerprint", "root", "place", "row_hash")
    marked = keep(with_fingerprint(docs, text_col, fp, width))
    prints = keep(marked.select(F.col(fp).alias("fingerprint")).distinct())
    roots = keep(components(links(prints, budget)).select(F.col("node").alias(fp), F.col("root").alias(root)))
    hashed = [F.col(f"`{f.name}`") for f in docs.schema if not f.dataType.simpleString().startswith(("map", "variant"))]
    order = Window.partitionBy(root).orderBy(F.col(id_col).asc_nulls_last(), row)
    return (marked.join(roots, fp, "left").withColumn(root, F.coalesce(root, fp)).withColumn(row, F.xxhash64(*hashed))
            .withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).select(*docs.columns))
