"""How far the sources of a language lie apart, by the words they use.

Each language keeps the terms of enough of its documents; a term's list of (source, count) is a
row of the term-major index. The triangular discrimination of two sources sums
``f(p, q) = floor((p - q)^2 / (p + q))`` over every kept term, of smoothed shares in billionths.
Most of these terms neither source has: ``f`` of their two zero shares, the baseline, is counted
once for all kept terms and corrected where one source has the term (from the source's counts of
equal shares) and where both have it. The last come from the index, row by row: a source scatters
its terms through their lists into one dense accumulator over its peers, and only sums of
accumulators leave a task, never a pair of postings.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from snapgate.llm.common import flat, in_arrow, keep, map_chunks, runs

MIN_DOCUMENTS = 10
SCALE = 1_000_000_000
SMOOTHING = 2
TOP_TERMS = 10
#: Postings a task scatters at once.
POSTINGS = 1 << 20
#: Parts into which a language's pairs are dealt.
PARTS = 32

#: The lower-cased byte of a term, 0 for bytes between terms.
LETTER = np.arange(256, dtype=np.uint8)
LETTER[:65] = LETTER[91:97] = LETTER[123:128] = 0
LETTER[65:91] += 32


def term_counts(docs: DataFrame, group_cols=("lang", "source"), text_col="text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term, summed for each chunk.

    Terms are told apart by their bytes. A group in a chunk also has a row without a term, so that
    groups without terms are known.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in zip(group_cols, ("lang", "source"))),
                       F.col(text_col).alias("text"))

    def count(batch):
        data, offsets = flat(batch.column("text"))
        code = LETTER[data]
        start, end, doc = runs(code != 0, offsets)
        places = np.concatenate([[0], np.cumsum(end - start)])
        terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(places), pa.py_buffer(code[code != 0])])
        coded = terms.dictionary_encode()
        words, term = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        m = max(len(words), 1)
        # a document's equal terms side by side, then a group's
        in_doc, times = np.unique(doc * m + term, return_counts=True)
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        group, group_of = np.unique(lang.indices.to_numpy().astype(np.int64) * (len(source.dictionary) + 1) + source.indices.to_numpy(),
                                    return_inverse=True)
        key, at = np.unique(group_of[in_doc // m] * m + in_doc % m, return_inverse=True)
        n = np.bincount(at, times, len(key)).astype(np.int64)
        by = np.concatenate([group[key // m], group])
        none = pa.nulls(len(group), pa.large_binary())
        zeros = np.zeros(len(group), np.int64)
        columns = [lang.dictionary.take(pa.array(by // (len(source.dictionary) + 1))),
                   source.dictionary.take(pa.array(by % (len(source.dictionary) + 1))),
                   pa.chunked_array([words.take(pa.array(key % m)), none]).combine_chunks().cast(pa.binary()).cast(pa.string()),
                   pa.array(np.concatenate([n, zeros])), pa.array(np.concatenate([np.bincount(at, minlength=len(key)), zeros]))]
        return pa.RecordBatch.from_arrays([c.cast(t) for c, t in zip(columns, [pa.string()] * 3 + [pa.int64()] * 2)],
                                          ["lang", "source", "term", "n", "docs"])

    parts = map_chunks(rows, "text", "lang string, source string, term string, n long, docs long", count)
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), exact beyond 64 bits."""
    top = (n + SMOOTHING).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", top, (total + SMOOTHING * kept).cast("decimal(19,0)")) + 1


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def scatter(first, last, source, p, p0, number: int):
    """The accumulators of one language's part of the index: (source, peer, value), peer beyond source.

    ``first`` and ``last`` bound each posting's list behind it: the peers' postings of its term,
    by source. Sums stay below 2**53, so that doubles hold them exactly.
    """
    out = []
    order = np.argsort(source, kind="stable")
    for mine in np.split(order, np.flatnonzero(np.diff(source[order])) + 1):
        size = last[mine] - first[mine]
        row = np.repeat(mine, size)
        peer = np.arange(len(row)) + np.repeat(first[mine] - (np.cumsum(size) - size), size)
        value = _f(p[row], p[peer]) - _f(p[row], p0[peer]) - _f(p0[row], p[peer]) + _f(p0[row], p0[peer])
        dense = np.bincount(source[peer], value, number)
        met = np.flatnonzero(np.bincount(source[peer], minlength=number))
        out.append((np.full(len(met), source[mine[0]]), met, dense[met].astype(np.int64)))
    return [np.concatenate(c) for c in zip(*out)]


def _scattered(batches):
    """The index rows of a task in parts of about ``POSTINGS`` postings, each scattered by language."""
    def emit(rows):
        table = pa.Table.from_batches(rows)
        langs = table.column("lang").combine_chunks().dictionary_encode()
        if isinstance(langs, pa.ChunkedArray):
            langs = langs.combine_chunks()
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            postings = table.filter(pc.equal(langs.indices, i)).column("postings").combine_chunks()
            postings = postings.combine_chunks() if isinstance(postings, pa.ChunkedArray) else postings
            size = np.diff(postings.offsets.to_numpy())
            flattened = postings.flatten()
            source, p, p0 = (flattened.field(c).to_numpy().astype(np.int64) for c in ("id", "p", "p0"))
            last = np.repeat(np.cumsum(size), size)
            a, b, value = scatter(np.arange(len(source)) + 1, last, source, p, p0, int(source.max()) + 1)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(value)],
                                             ["lang", "a", "b", "value"])

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += len(batch.column("postings").flatten())
        if size >= POSTINGS:
            yield from emit(held)
            held, size = [], 0
    if held:
        yield from emit(held)


def divergence(docs: DataFrame, lang_col="lang", source_col="source", text_col="text", min_docs=MIN_DOCUMENTS,
               top_terms=TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank): each source's peers and its own most telling terms.

    Part ``pair`` has every other source of the language with the summed distance over the kept
    terms, 0 where there are none; part ``term`` the kept terms the source uses more than its
    language, with their distance from it. Ranks go by value, then by the item's bytes. A null
    text, language or source is empty; every row counts, repeated ones too; an empty table has no
    groups. Only the three named columns are read.
    """
    counts = keep(term_counts(docs, (lang_col, source_col), text_col))
    index = keep(counts.where("term is not null").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("postings"))
        .where(F.col("docs") >= min_docs).drop("docs"))
    langs = index.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("n").alias("lang_total"))
    known = index.select("lang", F.inline("postings")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (counts.where("term is null").select("lang", "source").join(known, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *(F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("total", "kept", "lang_total"))))
    # a language without kept terms has no shares
    zero = F.when(F.col("kept") > 0, share(F.lit(0), F.col("total"), F.col("kept")))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    groups = keep(groups.withColumns({"p0": zero, "id": number}))

    flat_index = index.select("lang", "term", F.col("n").alias("lang_n"), F.inline("postings"))
    shares = keep(flat_index.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "id", "p0", share(F.col("n"), F.col("total"), F.col("kept")).alias("p"),
        share(F.col("lang_n"), F.col("lang_total"), F.col("kept")).alias("q")))

    by_term = shares.groupBy("lang", "term").agg(F.sort_array(F.collect_list(F.struct("id", "p", "p0"))).alias("postings"))
    both = (in_arrow(by_term.select("lang", "postings"), _scattered, "lang string, a int, b int, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("both")))
    equal = shares.groupBy("lang", "id", "p").agg(F.count("*").alias("n"))
    equal = equal.groupBy("lang", "id").agg(F.collect_list(F.struct("p", "n")).alias("equal"))
    one = groups.join(equal, ["lang", "id"], "left")

    left = one.select("lang", F.pmod("id", F.lit(PARTS)).alias("part"), F.col("id").alias("a"), F.col("source").alias("a_source"),
                      F.col("p0").alias("a0"), F.col("equal").alias("a_equal"), "kept")
    right = one.select("lang", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), F.col("id").alias("b"),
                       F.col("source").alias("b_source"), F.col("p0").alias("b0"), F.col("equal").alias("b_equal"))

    def corrected(equal, mine, other):
        add = lambda acc, x: acc + x["n"] * (distance(x["p"], F.col(other)) - distance(F.col(mine), F.col(other)))
        return F.coalesce(F.aggregate(equal, F.lit(0).cast("long"), add), F.lit(0))

    pairs = left.join(right, ["lang", "part"]).where("a < b").join(both, ["lang", "a", "b"], "left")
    total = (F.coalesce(F.col("kept") * distance(F.col("a0"), F.col("b0")), F.lit(0)) + corrected("a_equal", "a0", "b0")
             + corrected("b_equal", "b0", "a0") + F.coalesce("both", F.lit(0)))
    pairs = pairs.select("lang", total.alias("value"), F.array(*(
        F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("a_source", "b_source"), ("b_source", "a_source")))).alias("ends"))
    pairs = pairs.select("lang", "value", F.inline("ends")).select("lang", "source", F.lit("pair").alias("part"), "item", "value")
    terms = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         distance(F.col("p"), F.col("q")).alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [t.withColumn("rank", F.row_number().over(best)) for t in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top_terms))
