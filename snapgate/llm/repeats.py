"""Removal of repeated byte strings by threshold-bounded interval expansion.

A byte goes if a string of ``MIN_BYTES`` bytes over it starts anywhere else in the corpus. Suffixes
are sampled so that none of interest is lost: of the 40-byte strings in each window of that length
the one with the smallest hash is an anchor, so equal windows have anchors with the same hash at the
same offset, and text without a twin never leaves the first shuffle.

Of the anchors found more than once those whose whole surroundings are equal are repeated as they
are. The others are expanded: the suffixes that begin at the anchors of one hash are sorted, which
gives their intervals of common prefixes, and extended backwards breadth-first. A step takes the
symbol before each suffix (its Burrows-Wheeler symbol) and splits the intervals by it, stably, as the
LF mapping does; intervals whose common prefix, the extension included, reaches the threshold
and that hold two suffixes are repeated windows, and no prefix beyond the threshold is looked at.

An anchor with more than ``HOT_GROUP`` suffixes is never gathered: its intervals are extended by
``SPAN`` offsets at once and then by one, as hashes that are counted where they lie. In periodic text,
where a surrounding holds the anchor at many places, each of its windows is hashed and counted once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from snapgate.llm.common import CHUNK_BYTES, chunks, flat, forget, in_arrow, keep, map_chunks, mix, powers, prefix_sums, substring_hashes

MIN_BYTES = 200
ANCHOR_BYTES = 40
#: Bytes beside an anchor that a window over it can reach.
REACH = MIN_BYTES - ANCHOR_BYTES
#: Suffixes of an anchor that one task expands.
HOT_GROUP = 16_384
#: Suffixes that a surrounding of periodic text has at most; another has one.
LOOP_SUFFIXES = 2 * REACH + 1
#: Offsets that are looked at together in a hot group.
SPAN = 23


def _window_min(values, width):
    """Minimum of each window of ``width`` values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[:len(values) - (width - size)], values[width - size:]) if size < width else values


def anchors(data, offsets):
    """Places, hashes, hashes of the surroundings and thinned marks of all anchors, with their documents.

    Of anchors with the same hash that follow each other closely, as in periodic text, enough
    stay that every window still has one; these are marked, since a window may then be its own
    neighbour's twin over a single anchor.
    """
    n = len(data)
    empty = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool), np.zeros(0, np.int64))
    long = np.flatnonzero(np.diff(offsets) >= MIN_BYTES)
    if not len(long):
        return empty
    sums = prefix_sums(data)
    _, down = powers(n)
    m = n - ANCHOR_BYTES + 1
    h = mix((sums[ANCHOR_BYTES:] - sums[:m]) * down[:m])
    bits = np.uint64(max(1, int(n).bit_length()))
    low = _window_min(((h >> bits) << bits) | np.arange(m, dtype=np.uint64), REACH + 1)
    # windows that lie in one document
    counts = np.diff(offsets)[long] - MIN_BYTES + 1
    begin = np.cumsum(counts) - counts
    window = np.repeat(offsets[:-1][long] - begin, counts) + np.arange(int(counts.sum()))
    at = (low[window] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    at = np.unique(at)
    doc = np.searchsorted(offsets, at, "right") - 1
    value = h[at]
    gap = np.diff(at)
    follows = np.concatenate([[False], (value[1:] == value[:-1]) & (doc[1:] == doc[:-1]) & (gap <= REACH // 2)])
    head = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
    cell = (at - at[head]) // (REACH // 2)
    stay = ~follows | np.concatenate([[True], cell[1:] != cell[:-1]]) | ~np.append(follows[1:], False)
    loop = follows | np.append(follows[1:], False)
    at, doc, value, loop = at[stay], doc[stay], value[stay], loop[stay]
    a, b = np.maximum(at - REACH, offsets[doc]), np.minimum(at + ANCHOR_BYTES + REACH, offsets[doc + 1])
    around = mix(substring_hashes(sums, a, b) + (at - a).astype(np.uint64))
    return at, value, around, loop, doc


def expand(left, n_left, right, n_right, group, place, weight):
    """For each suffix the offsets, in bytes before the anchor, of the repeated windows over it.

    left: bytes before the anchor, nearest first, and right: after it, as rows of ``REACH`` bytes
    with how many of them there are; group: anchors of one hash; place: the place in the corpus,
    so that one place met twice is no repetition; weight: places with just these surroundings.
    Returns a Boolean row of REACH + 1 offsets for each suffix.
    """
    n = len(group)
    out = np.zeros((n, REACH + 1), bool)
    if not n:
        return out
    order = np.lexsort((_rank(right), group))
    lcp = np.zeros(n, np.int64)
    same = group[order[1:]] == group[order[:-1]]
    differ = right[order[1:]] != right[order[:-1]]
    lcp[1:] = np.where(same, np.where(differ.any(1), differ.argmax(1), REACH), -1)
    lcp[0] = -1
    live, interval = order, np.cumsum(~np.concatenate([[False], same]))
    position = np.empty(n, np.int64)
    position[order] = np.arange(n)
    for step in range(REACH + 1):
        if step:
            has = n_left[live] >= step
            live, interval = live[has], interval[has]
            symbol = left[live, step - 1].astype(np.int64)
            key = interval * 256 + symbol
            turn = np.argsort(key, kind="stable")
            live, key = live[turn], key[turn]
            interval = np.cumsum(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else key
        # alone in its interval: no longer prefix can be shared
        size = np.bincount(interval)
        stay = (size[interval] > 1) | (weight[live] > 1)
        live, interval = live[stay], interval[stay]
        if not len(live):
            break
        need = REACH - step
        shared = np.cumsum(lcp < need)[position[live]]
        full = np.flatnonzero(n_right[live] >= need)
        if not len(full):
            continue
        who = live[full]
        key = interval[full] * (n + 1) + shared[full]
        turn = np.argsort(key, kind="stable")
        who, key = who[turn], key[turn]
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        count = np.diff(np.append(cut, len(key)))
        twice = (np.minimum.reduceat(place[who], cut) != np.maximum.reduceat(place[who], cut)) | (np.maximum.reduceat(weight[who], cut) > 1)
        out[who[np.repeat(twice, count)], step] = True
    return out


def _rank(rows):
    """Ranks of byte rows in lexicographic order; equal rows share one."""
    wide = np.ascontiguousarray(rows).reshape(len(rows), -1, 8).view(">u8")[:, :, 0]
    rank = np.zeros(len(rows), np.int64)
    for k in range(wide.shape[1]):
        _, part = np.unique(wide[:, k], return_inverse=True)
        key = rank * (int(part.max()) + 1) + part
        _, rank = np.unique(key, return_inverse=True)
    return rank


def _suffixes(data, offsets, anchor, before, many):
    """Row, point in ``data`` and bytes to the left and right of each suffix.

    In rows of ``many``, those of periodic text, each place of the anchor counts.
    """
    row, point = np.arange(len(anchor)), offsets[:-1] + before
    if many.any():
        sums = prefix_sums(data)
        _, down = powers(len(data))
        m = len(data) - ANCHOR_BYTES + 1
        h = mix((sums[ANCHOR_BYTES:] - sums[:m]) * down[:m])
        mine = np.repeat(np.arange(len(anchor)), np.diff(offsets))[:m]
        hit = np.flatnonzero(many[mine] & (h.view(np.int64) == anchor[mine]) & (np.arange(m) + ANCHOR_BYTES <= offsets[mine + 1]))
        row, point = np.concatenate([row[~many], mine[hit]]), np.concatenate([point[~many], hit])
    return row, point, np.minimum(point - offsets[row], REACH), np.minimum(offsets[row + 1] - point - ANCHOR_BYTES, REACH)


def _expand_groups(batches):
    """:func:`_expand_rows` over whole groups of the sorted anchors, of some ``HOT_GROUP`` suffixes at most."""
    for table in _whole_groups(batches):
        anchor, loop = table.column("anchor").to_numpy(), table.column("loop").to_numpy()
        cut = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        rows = np.diff(np.append(cut, len(anchor)))
        ends = np.cumsum(rows * np.where(np.logical_or.reduceat(loop, cut), LOOP_SUFFIXES, 1))
        first = 0
        while first < len(cut):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + HOT_GROUP, "right")))
            yield _expand_rows(table.slice(int(cut[first]), int(rows[first:last].sum())))
            first = last


def _expand_rows(table: pa.Table):
    """(doc, start, end) of the repeated stretches in the given surroundings of anchors."""
    data, offsets = flat(table.column("bytes"))
    anchor, doc, at, weight, before, loop = (table.column(c).to_numpy() for c in ("anchor", "doc", "at", "weight", "before", "loop"))
    _, group = np.unique(anchor, return_inverse=True)
    looped = np.zeros(int(group.max()) + 1, bool)
    looped[group[loop]] = True
    row, point, n_left, n_right = _suffixes(data, offsets, anchor, before, looped[group])
    reach = np.arange(REACH)
    padded = np.concatenate([data, np.zeros(1, np.uint8)])
    gather = lambda index, inside: padded[np.where(inside, index, len(data))]
    left = gather(point[:, None] - 1 - reach, reach < n_left[:, None])
    right = gather(point[:, None] + ANCHOR_BYTES + reach, reach < n_right[:, None])
    corpus = at[row] - before[row] + (point - offsets[row])
    _, place = np.unique(np.stack([doc[row], corpus]), axis=1, return_inverse=True)
    marks = expand(left, n_left, right, n_right, group[row], place.ravel(), weight[row])
    # offsets next to each other are one stretch
    edge = np.diff(np.pad(marks, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    who, first = np.nonzero(edge == 1)
    _, after = np.nonzero(edge == -1)
    start, stop = corpus[who] - (after - 1), corpus[who] - first + MIN_BYTES
    return pa.RecordBatch.from_arrays([pa.array(doc[row][who]), pa.array(start), pa.array(stop)], ["doc", "start", "stop"])


_SPANS = "shared long, cover long, doc long, point long, weight long, first int, last int, windows array<long>"
#: Rows of ``_SPANS`` without ``windows``: a window at ``point``, hashed as ``shared``; without ``shared``: a repeated stretch.
_WINDOW, _STRETCH = "windows is null and shared is not null", "shared is null"


def _hot_rows(batch):
    """Rows of ``_SPANS`` for a batch of surroundings of hot anchors."""
    loop = batch.column("loop")
    for rows, spans in ((batch.filter(pc.invert(loop)), _hot_spans), (batch.filter(loop), _loop_windows)):
        if rows.num_rows:
            yield from spans(rows)


def _hot_spans(batch):
    """For each suffix and each ``SPAN`` offsets that have windows: hashes of the bytes that all windows at
    these offsets hold, of those they cover together and of each window, with the first and last offset."""
    data, offsets = flat(batch.column("bytes"))
    anchor, doc, at, weight, before = (batch.column(c).to_numpy() for c in ("anchor", "doc", "at", "weight", "before"))
    row, point, n_left, n_right = _suffixes(data, offsets, anchor, before, np.zeros(len(anchor), bool))
    sums, step = prefix_sums(data), np.arange(REACH + 1)
    who, offset = np.nonzero((step <= n_left[:, None]) & (step >= REACH - n_right[:, None]))
    windows = substring_hashes(sums, point[who] - offset, point[who] - offset + MIN_BYTES)
    span = offset // SPAN
    cut = np.flatnonzero(np.concatenate([[True], (who[1:] != who[:-1]) | (span[1:] != span[:-1])])[:len(who)])
    stop = np.append(cut[1:], len(who))
    who, low, first, last = who[cut], span[cut] * SPAN, offset[cut], offset[stop - 1]
    high = np.minimum(low + SPAN - 1, REACH)
    here, salt = point[who], low.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    shared = mix(substring_hashes(sums, here - low, here - high + MIN_BYTES) + salt)
    cover = mix(substring_hashes(sums, here - last, here - first + MIN_BYTES) + first.astype(np.uint64))
    mine = row[who]
    yield pa.RecordBatch.from_arrays(
        [pa.array(shared.view(np.int64)), pa.array(cover.view(np.int64)), pa.array(doc[mine]),
         pa.array(at[mine] - before[mine] + (here - offsets[mine])), pa.array(weight[mine]), pa.array(first.astype(np.int32)),
         pa.array(last.astype(np.int32)), pa.ListArray.from_arrays(np.append(cut, len(windows)).astype(np.int32), pa.array(windows.view(np.int64)))],
        ["shared", "cover", "doc", "point", "weight", "first", "last", "windows"])


def _loop_windows(batch):
    """Each different window over the anchors of the batch once, with its place, and the stretches that are repeated in the batch.

    A window that is repeated in the batch has a weight of 2 and its places are in the stretches.
    """
    data, offsets = flat(batch.column("bytes"))
    doc, at, weight, before = (batch.column(c).to_numpy() for c in ("doc", "at", "weight", "before"))
    count = np.maximum(np.minimum(before, np.diff(offsets) - MIN_BYTES) + 1, 0)
    row = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    window = substring_hashes(prefix_sums(data), offsets[row] + step, offsets[row] + step + MIN_BYTES).view(np.int64)
    doc, start, more = doc[row], (at - before)[row] + step, weight[row] > 1
    # places, each once
    order = np.lexsort((~more, start, doc))
    doc, start, window, more = doc[order], start[order], window[order], more[order]
    once = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] != start[:-1])])[:len(doc)]
    doc, start, window, more = doc[once], start[once], window[once], more[once]
    _, one, which, places = np.unique(window, return_index=True, return_inverse=True, return_counts=True)
    twice = (places > 1) | (np.bincount(which, more, len(one)) > 0)
    n = len(one)
    yield _spans_of(n, shared=window[one], doc=doc[one], point=start[one], weight=np.where(twice, 2, 1))
    mark = np.flatnonzero(twice[which])
    doc, start = doc[mark], start[mark]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)])[:len(doc)]
    first, last = np.flatnonzero(new), np.flatnonzero(np.append(new[1:], True)[:len(doc)])
    yield _spans_of(len(first), doc=doc[first], point=start[first], cover=start[last] + MIN_BYTES)


def _spans_of(n, **columns):
    """A batch of ``_SPANS`` with the given columns, null in the others."""
    kinds = {"first": pa.int32(), "last": pa.int32(), "windows": pa.list_(pa.int64())}
    names = ["shared", "cover", "doc", "point", "weight", "first", "last", "windows"]
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(columns[c], np.int64)) if c in columns else pa.nulls(n, kinds.get(c, pa.int64()))
                                       for c in names], names)


def _hot_stretches(around: DataFrame) -> DataFrame:
    """(doc, start, stop) of the repeated stretches in the surroundings of hot anchors, by counting hashes only."""
    rows = keep(in_arrow(around, lambda batches: (out for batch in chunks(batches, "bytes") for out in _hot_rows(batch)), _SPANS))
    spans = rows.where("windows is not null")

    def repeated(rows, by, *more):
        place = F.struct("doc", "point")
        return (rows.groupBy(by).agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("weight").alias("w"), *more)
                .where("a <> b or w > 1").drop("a", "b", "w"))

    found = spans.join(keep(repeated(spans, "shared", (F.min("cover") == F.max("cover")).alias("even"))), "shared")
    even = found.where("even").select("doc", (F.col("point") - F.col("last")).alias("start"),
                                      (F.col("point") - F.col("first") + MIN_BYTES).alias("stop"))
    each = keep(found.where("not even").select("doc", "point", "weight", "first", F.posexplode("windows").alias("k", "window"))
                .select("window", "doc", (F.col("point") - F.col("first") - F.col("k")).alias("point"), "weight"))
    looped = rows.where(_WINDOW)
    twice = (each.join(keep(repeated(each, "window")), "window", "left_semi").select("doc", "point")
             .unionByName(looped.where("weight = 1").join(keep(repeated(looped, "shared")), "shared", "left_semi").select("doc", "point")))
    return (even.unionByName(twice.select("doc", F.col("point").alias("start"), (F.col("point") + MIN_BYTES).alias("stop")))
            .unionByName(rows.where(_STRETCH).select("doc", F.col("point").alias("start"), F.col("cover").alias("stop"))))


def _whole_groups(batches, limit=CHUNK_BYTES):
    """Tables of whole groups of the sorted anchors, of some ``limit`` bytes."""
    held, size, last = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        anchor = batch.column("anchor").to_numpy()
        cut = 0
        if size >= limit:
            other = np.flatnonzero(anchor != last)
            cut = int(other[0]) if len(other) else len(anchor)
            held.append(batch.slice(0, cut))
            if cut == len(anchor):
                continue
            yield pa.Table.from_batches(held)
            held, size = [], 0
        held.append(batch.slice(cut))
        size, last = size + batch.nbytes, anchor[-1]
    if held:
        yield pa.Table.from_batches(held)


def _removed(batch):
    """Digest columns of each text without the marked stretches."""
    data, offsets = flat(batch.column("text"))
    raw, n = data.tobytes(), len(offsets) - 1
    marks = batch.column("marks")
    removed, spans, kept = np.zeros(n, np.int64), np.zeros(n, np.int64), []
    for i in range(n):
        a, b = int(offsets[i]), int(offsets[i + 1])
        mine = marks[i].as_py() if marks[i].is_valid else []
        parts, done, gone, count = [], 0, 0, 0
        reached = -1
        for m in sorted((max(0, m["start"]), min(b - a, m["stop"])) for m in mine):
            if m[0] > reached:
                parts.append(raw[a + done:a + m[0]])
                count += 1
                gone += m[1] - m[0]
                done = reached = m[1]
            elif m[1] > reached:
                gone += m[1] - reached
                done = reached = m[1]
        parts.append(raw[a + done:b])
        removed[i], spans[i] = gone, count
        kept.append(hashlib.sha256(b"".join(parts)).hexdigest())
    return [pa.array(np.diff(offsets)), pa.array(removed), pa.array(spans), pa.array(kept, pa.string())]


def _meet(rows: DataFrame, keys: DataFrame, by: list[str], hot: int) -> DataFrame:
    """``rows`` joined with the keys, of which each has ``n`` rows.

    The few keys with more than ``hot`` rows are a table of their own, small enough for Spark to
    send it to the rows, so that no task gets all rows of such a key.
    """
    large = keep(keys.where(F.col("n") > hot))
    return rows.join(large, by).unionByName(rows.join(large.select(*by), by, "left_anti").join(keys.where(F.col("n") <= hot), by))


def repeated_stretches(texts: DataFrame, hot=HOT_GROUP) -> DataFrame:
    """(doc, start, stop): stretches of texts (doc, text) that are repeated, overlapping ones included."""
    def scan(batches):
        for batch in chunks(batches, "text", CHUNK_BYTES // 2):
            data, offsets = flat(batch.column("text"))
            at, value, around, loop, doc = anchors(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(value.view(np.int64)), pa.array(around.view(np.int64)), pa.array(batch.column("doc").to_numpy()[doc]),
                 pa.array((at - offsets[doc]).astype(np.int32)), pa.array(loop)], ["anchor", "around", "doc", "at", "loop"])

    found = keep(in_arrow(texts.select("doc", "text"), scan, "anchor long, around long, doc long, at int, loop boolean"))
    counts = keep(found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("around").alias("a"), F.max("around").alias("b"), F.max("loop").alias("loops"))
                  .where("n > 1 or loops").select("anchor", "n", F.expr("n > 1 and a = b and not loops").alias("equal")))
    shared = keep(_meet(found, counts, ["anchor"], hot).drop("n"))
    forget(found)
    whole = F.struct((F.col("at") - REACH).alias("start"), (F.col("at") + ANCHOR_BYTES + REACH).alias("stop"))
    mixed = shared.where("not equal")
    kinds = keep(mixed.groupBy("anchor", "around").agg(
        F.count("*").alias("weight"), F.min(F.struct("doc", "at")).alias("one"), F.max("loop").alias("loop")).select("anchor", "around", "weight", "loop", "one.*"))
    copies = _meet(mixed, kinds.where("weight > 1").select("anchor", "around", F.col("weight").alias("n")), ["anchor", "around"], hot)
    equal = shared.where("equal").select("doc", whole.alias("m")).unionByName(copies.select("doc", whole.alias("m"))).select("doc", "m.start", "m.stop")

    def surroundings(rows):
        """One of each surroundings, with its bytes."""
        asked = rows.groupBy("doc").agg(F.collect_list(F.struct("anchor", "at", "weight", "loop")).alias("asked"))
        begin = F.greatest(F.lit(0), F.col("q.at") - REACH)
        return (texts.join(asked, "doc").select("doc", "text", F.explode("asked").alias("q"))
                .select("q.anchor", "doc", "q.at", "q.weight", "q.loop", (F.col("q.at") - begin).alias("before"),
                        F.substring(F.col("text").cast("binary"), begin + 1, F.col("q.at") - begin + ANCHOR_BYTES + REACH).alias("bytes")))

    large = keep(kinds.groupBy("anchor").agg(F.count("*").alias("n"), F.max("loop").alias("loops"))
                 .where(F.col("n") * F.when(F.col("loops"), LOOP_SUFFIXES).otherwise(1) > hot).select("anchor", "loops"))
    around = surroundings(kinds.join(large, "anchor", "left").where("loops is null").drop("loops")).repartition("anchor").sortWithinPartitions("anchor")
    expanded = in_arrow(around, _expand_groups, "doc long, start long, stop long")
    counted = _hot_stretches(surroundings(kinds.join(large, "anchor").withColumn("loop", F.col("loops"))))
    return (equal.select("doc", F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"))
            .unionByName(expanded).unionByName(counted))


def remove_repeats(docs: DataFrame, id_col="doc_id", text_col="text", hot=HOT_GROUP) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) of each row.

    A null text is empty. Texts shorter than ``MIN_BYTES`` bytes stay whole. A repeated row is
    another place, so a text that comes twice goes wholly.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.xxhash64(F.col(id_col), text).alias("doc"), F.col(id_col).alias("id"), text.alias("text"))
    marks = repeated_stretches(texts, hot).groupBy("doc").agg(F.collect_set(F.struct("start", "stop")).alias("marks"))
    rows = texts.join(marks, "doc", "left").select("id", "text", "marks")
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    schema = rows.select("id", *(F.lit(0).cast("long").alias(c) for c in names[:3]), F.lit("").alias(names[3])).schema
    return map_chunks(rows, "text", schema, lambda b: pa.RecordBatch.from_arrays([b.column("id"), *_removed(b)], ["id", *names])
                      ).withColumnRenamed("id", id_col)
