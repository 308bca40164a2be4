"""Benchmark decontamination: windows of test words in training texts, verified and cut out.

The benchmark's windows of ten words go into a hash set that every task holds; a task slides a
window over its texts, looks the hashes up and compares the bytes of each hit. The set is made
of blocks of at most ``BLOCK_BYTES`` of benchmark words, which the driver broadcasts one at a
time, so nothing that is broadcast grows with the benchmark: a larger one takes more blocks, each
scanned over all documents, and the words a document has hit in any block are put together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapgate.llm.common import flat, fresh, in_arrow, keep, map_chunks, prefix_sums, runs, substring_hashes

WINDOW_WORDS = 10
#: Bytes of benchmark words in a block.
BLOCK_BYTES = 16 << 20
#: Words of a segment; longer items are cut into segments that share all but one word of a window.
SEGMENT_WORDS = 4096
#: Hits whose bytes are compared at once.
STEP = 1 << 15

#: The lower-cased byte of a word, 0 for bytes between words.
WORD = np.arange(256, dtype=np.uint8)
WORD[:48] = WORD[58:65] = WORD[91:97] = WORD[123:128] = 0
WORD[65:91] += 32


@dataclass
class Words:
    """Words joined by one space, where each lies there and in the given bytes, and its text."""
    text: np.ndarray
    at: np.ndarray
    to: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray


@dataclass
class Level:
    """Windows of one number of words by hash: where one of each lies, and which items have it."""
    words: int
    hashes: np.ndarray
    at: np.ndarray
    to: np.ndarray
    set_of: np.ndarray
    sieve: np.ndarray


@dataclass
class Table:
    text: np.ndarray
    levels: list[Level]
    sets: list[tuple[str, ...]]


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    code = WORD[data]
    start, end, doc = runs(code != 0, offsets)
    size = end - start
    at = np.cumsum(size + 1) - size - 1
    text = np.full(int(size.sum()) + len(size), 32, np.uint8)
    inside = np.flatnonzero(code)
    text[inside + np.repeat(at - start, size)] = code[inside]
    return Words(text, at, at + size, start, end, doc)


def _windows(words: Words, size: int) -> np.ndarray:
    """First words of the windows of ``size`` words that stay in a text."""
    m = len(words.at) - size + 1
    return np.flatnonzero(words.doc[:m] == words.doc[size - 1:]) if m > 0 else np.zeros(0, np.int64)


def _equal(text, at, to, other, other_at, other_to) -> np.ndarray:
    """Which substrings are equal, byte by byte."""
    same = (to - at) == (other_to - other_at)
    for first in range(0, len(at), STEP):
        pick = first + np.flatnonzero(same[first:first + STEP])
        size = to[pick] - at[pick]
        begin = np.cumsum(size) - size
        inner = np.arange(int(size.sum())) - np.repeat(begin, size)
        wrong = text[np.repeat(at[pick], size) + inner] != other[np.repeat(other_at[pick], size) + inner]
        same[pick[np.repeat(np.arange(len(pick)), size)[wrong]]] = False
    return same


def _sieve(hashes: np.ndarray) -> np.ndarray:
    """A table of the low bits that occur; its length is a power of two, eight times the hashes."""
    table = np.zeros(1 << max(10, int(8 * len(hashes)).bit_length()), bool)
    table[(hashes & np.uint64(len(table) - 1)).astype(np.int64)] = True
    return table


def table_of(segments: list[tuple[str | None, bytes]], window=WINDOW_WORDS) -> Table:
    """The windows of segments (item, words joined by spaces), exact whatever their hashes."""
    bodies = [b for _, b in segments]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in bodies])]).astype(np.int64)
    words = words_of(np.frombuffer(b"".join(bodies), np.uint8), offsets)
    names = sorted({i for i, _ in segments if i is not None})
    number = {name: k for k, name in enumerate(names)}
    item = np.array([number.get(i, -1) for i, _ in segments], np.int64)
    count = np.bincount(words.doc, minlength=len(bodies))
    sums, sets, levels = prefix_sums(words.text), {}, []

    def set_number(items):
        return sets.setdefault(items, len(sets))

    for size in sorted({window, *count[(count > 0) & (count < window)].tolist()}):
        left = _windows(words, size)
        if size < window:
            left = left[count[words.doc[left]] == size]
        while len(left):
            at, to = words.at[left], words.to[left + size - 1]
            hashes, first, group = np.unique(substring_hashes(sums, at, to), return_index=True, return_inverse=True)
            equal = _equal(words.text, at, to, words.text, at[first[group]], to[first[group]])
            # (window, item) pairs in order, so that each window's items are a slice
            pairs = np.unique(group[equal] * (len(names) + 1) + item[words.doc[left[equal]]] + 1)
            owner, member = pairs // (len(names) + 1), pairs % (len(names) + 1) - 1
            cuts = np.searchsorted(owner, np.arange(len(hashes) + 1))
            member = member.tolist()
            set_of = np.array([set_number(tuple(m for m in member[i:j] if m >= 0)) for i, j in zip(cuts, cuts[1:])], np.int64)
            levels.append(Level(size, hashes, at[first], to[first], set_of, _sieve(hashes)))
            left = left[~equal]   # other words of a hash that is taken: a level of their own
    return Table(words.text, levels, [tuple(names[m] for m in s) for s in sets])


def scan(words: Words, table: Table, n_docs: int) -> tuple[np.ndarray, list[list[str]]]:
    """Which words lie in an occurring window, and the items of each text, sorted."""
    depth = np.zeros(len(words.at) + 1, np.int64)
    sums, found = prefix_sums(words.text), [np.zeros(0, np.int64)]
    for level in table.levels:
        first = _windows(words, level.words)
        h = substring_hashes(sums, words.at[first], words.to[first + level.words - 1])
        maybe = level.sieve[(h & np.uint64(len(level.sieve) - 1)).astype(np.int64)]
        first, h = first[maybe], h[maybe]
        k = np.minimum(np.searchsorted(level.hashes, h), len(level.hashes) - 1)
        hit = level.hashes[k] == h
        first, k = first[hit], k[hit]
        equal = _equal(words.text, words.at[first], words.to[first + level.words - 1], table.text, level.at[k], level.to[k])
        first, k = first[equal], k[equal]
        depth += np.bincount(first, minlength=len(depth)) - np.bincount(first + level.words, minlength=len(depth))
        found.append(words.doc[first] * len(table.sets) + level.set_of[k])
    items = [[] for _ in range(n_docs)]
    pairs = np.unique(np.concatenate(found))
    for doc, one in zip((pairs // max(len(table.sets), 1)).tolist(), (pairs % max(len(table.sets), 1)).tolist()):
        items[doc].append(table.sets[one])
    items = [list(s[0]) if len(s) == 1 else sorted(set().union(*s)) for s in items]
    return np.cumsum(depth[:-1]) > 0, items


def segments(benchmark: DataFrame, id_col="item_id", text_col="text", window=WINDOW_WORDS) -> DataFrame:
    """(item, body): the distinct word sequences of the items, long ones cut so that no window is lost."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))

    def cut(batches):
        for batch in batches:
            words, names = words_of(*flat(batch.column("text"))), batch.column("item").to_pylist()
            bounds = np.searchsorted(words.doc, np.arange(len(names) + 1)).tolist()
            text, out = words.text.tobytes(), []
            for name, a, b in zip(names, bounds, bounds[1:]):
                for first in range(a, max(b - window + 1, min(a + 1, b)), SEGMENT_WORDS - window + 1):
                    out.append((name, text[words.at[first]:words.to[min(first + SEGMENT_WORDS, b) - 1]]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.string()),
                                                  pa.array([t for _, t in out], pa.binary())], ["item", "body"])
    return in_arrow(rows, cut, "item string, body binary").distinct()


def blocks(benchmark: DataFrame, id_col="item_id", text_col="text", window=WINDOW_WORDS, block_bytes=BLOCK_BYTES):
    """The benchmark's tables, made one at a time, each of about ``block_bytes`` of words, and their number."""
    parts = keep(segments(benchmark, id_col, text_col, window))
    total = parts.agg(F.sum(F.length("body"))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    number = F.pmod(F.xxhash64("item", "body"), F.lit(n))
    return n, (table_of([(r[0], bytes(r[1])) for r in parts.where(number == i).select("item", "body").collect()], window) for i in range(n))


def _spans(words: Words, hit: np.ndarray, offsets: np.ndarray):
    """Runs of hit words of a text: first word, the word after the last, and the text."""
    bounds = np.searchsorted(words.doc, np.arange(len(offsets)))
    return runs(hit, bounds)


def _lists(values: pa.Array, owner: np.ndarray, n: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(n + 1)).astype(np.int32)), values)


def _report(batch, words, offsets, hit, items, carry, schema):
    """The carried columns, counts, items and spans in code points."""
    data, n = flat(batch.column("text"))[0], batch.num_rows
    first, last, doc = _spans(words, hit, offsets)
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    places = [point[p] - point[offsets[doc]] for p in (words.start[first], words.end[last - 1])]
    spans = pa.StructArray.from_arrays([pa.array(p.astype(np.int32)) for p in places], ["start", "end"])
    counts = [np.bincount(d, minlength=n).astype(np.int64) for d in (words.doc, words.doc[hit])]
    columns = [batch.column(c) for c in carry] + [pa.array(c) for c in counts]
    columns += [pa.array(items, pa.list_(pa.string())), _lists(spans, doc, n)]
    return pa.RecordBatch.from_arrays([c.cast(t.type) for c, t in zip(columns, schema)], schema=schema)


def _cut(batch, words, offsets, hit, text_at):
    """The batch with its texts less the bytes from the first to the last word of each span."""
    data, _ = flat(batch.column("text"))
    first, last, _ = _spans(words, hit, offsets)
    gone = np.zeros(len(data) + 1, np.int64)
    np.add.at(gone, words.start[first], 1)
    np.add.at(gone, words.end[last - 1], -1)
    stay = np.cumsum(gone[:-1]) == 0
    place = np.concatenate([[0], np.cumsum(stay)])[offsets]
    raw = data[stay].tobytes()
    old = batch.column("text")
    texts = [raw[a:b].decode("utf-8", "replace") if ok else None for a, b, ok in zip(place, place[1:], old.is_valid().to_pylist())]
    columns = [c for c, name in zip(batch.columns, batch.schema.names) if name != "text"]
    columns.insert(text_at, pa.array(texts, pa.string()))
    return columns


def _hits(docs: DataFrame, tables, n: int, window_rows):
    """``window_rows(rows, source)`` over ``docs``, where source gives a batch's hit words and items."""
    spark = docs.sparkSession
    if n == 1:
        shared = spark.sparkContext.broadcast(next(iter(tables)))
        return window_rows(docs, lambda batch, words: scan(words, shared.value, batch.num_rows), [])
    row, hits, items = fresh(docs, "row", "hits", "items")
    stored, parts = keep(docs.withColumn(row, F.monotonically_increasing_id())), []
    for table in tables:
        shared = spark.sparkContext.broadcast(table)

        def run(batch, shared=shared):
            words = words_of(*flat(batch.column("text")))
            hit, named = scan(words, shared.value, batch.num_rows)
            bounds = np.searchsorted(words.doc, np.arange(batch.num_rows + 1))
            first, last, doc = runs(hit, bounds)
            places = pa.StructArray.from_arrays([pa.array((p - bounds[doc]).astype(np.int64)) for p in (first, last)], ["a", "b"])
            out = pa.RecordBatch.from_arrays([batch.column("row"), _lists(places, doc, batch.num_rows),
                                              pa.array(named, pa.list_(pa.string()))], ["row", "hits", "items"])
            return out.filter(pa.array(np.bincount(doc, minlength=batch.num_rows) > 0))
        parts.append(keep(map_chunks(stored.select(F.col(row).alias("row"), "text"), "text",
                                     "row long, hits array<struct<a: long, b: long>>, items array<string>", run)))
        shared.unpersist()
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    merged = every.groupBy(F.col("row").alias(row)).agg(
        F.flatten(F.collect_list("hits")).alias(hits), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias(items))

    def known(batch, words):
        bounds = np.searchsorted(words.doc, np.arange(batch.num_rows + 1))
        hit = np.zeros(len(words.at), bool)
        for doc, spans in enumerate(batch.column(hits).to_pylist()):
            for s in spans or ():
                hit[bounds[doc] + s["a"]:bounds[doc] + s["b"]] = True
        return hit, [x or [] for x in batch.column(items).to_pylist()]
    return window_rows(stored.join(merged, row, "left").drop(row), known, [hits, items])


def contamination(docs: DataFrame, benchmark: DataFrame, carry=("doc_id",), text_col="text", item_col="item_id",
                  item_text_col="text", window=WINDOW_WORDS, block_bytes=BLOCK_BYTES) -> DataFrame:
    """The columns ``carry`` of each row, then n_words, n_hit, items (sorted) and spans (code points, end exclusive).

    A word inside any occurrence of an item's window is hit; a run of hit words is a span. An item
    of fewer words than a window is one window, one without words none. Rows are judged each, so
    repeated rows come out repeated; a null or empty text has no words. Repeated items count once,
    an item without an id hits words but is not listed. An empty benchmark hits nothing. An added
    column whose name is carried already gets an underscore.
    """
    carried = docs.select(*carry)
    names = fresh(carried, "n_words", "n_hit", "items", "spans")
    inner = [f"c{i}" for i in range(len(carry))]
    rows = docs.select(*(F.col(c).alias(i) for c, i in zip(carry, inner)), F.col(text_col).alias("text"))
    n, tables = blocks(benchmark, item_col, item_text_col, window, block_bytes)

    def window_rows(rows, source, _):
        added = [F.lit(0).cast("long"), F.lit(0).cast("long"), F.array().cast("array<string>"),
                 F.array().cast("array<struct<start: int, end: int>>")]
        schema = rows.select(*inner, *(c.alias(n) for c, n in zip(added, ("n_words", "n_hit", "items", "spans")))).schema
        arrow = _arrow(schema)

        def run(batch):
            data, offsets = flat(batch.column("text"))
            words = words_of(data, offsets)
            return _report(batch, words, offsets, *source(batch, words), inner, arrow)
        return map_chunks(rows, "text", schema, run)
    return _hits(rows, tables, n, window_rows).toDF(*carry, *names)


def _arrow(schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_col="text", item_col="item_id", item_text_col="text",
                 window=WINDOW_WORDS, block_bytes=BLOCK_BYTES) -> DataFrame:
    """The rows with every span cut out of its text, from its first word to its last. Nulls stay."""
    at = docs.columns.index(text_col)
    inner = ["text" if i == at else f"c{i}" for i in range(len(docs.columns))]
    n, tables = blocks(benchmark, item_col, item_text_col, window, block_bytes)

    def window_rows(rows, source, extra):
        schema = rows.drop(*extra).schema
        arrow = _arrow(schema)

        def run(batch):
            data, offsets = flat(batch.column("text"))
            words = words_of(data, offsets)
            hit, _ = source(batch, words)
            columns = _cut(batch.drop_columns(extra) if extra else batch, words, offsets, hit, at)
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], schema=arrow)
        return map_chunks(rows, "text", schema, run)
    return _hits(docs.toDF(*inner), tables, n, window_rows).toDF(*docs.columns)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col="text", **options) -> DataFrame:
    """The rows without a hit word."""
    found = contamination(docs, benchmark, docs.columns, text_col, **options)
    return found.where(F.col(found.columns[len(docs.columns) + 1]) == 0).select(*docs.columns)
