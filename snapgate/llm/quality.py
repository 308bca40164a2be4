"""Quality rules: base rules and a hashed n-gram log-likelihood ratio.

The ratio compares the n-grams of a document under two multinomials, one of trusted target
texts and one of the whole raw corpus, both over hashed byte n-grams with additive smoothing.
Counts are taken over all documents: each task sums dense arrays and the sums are added by
bucket, so a model has a fixed size whatever the input. The mean ratio per n-gram is held
against a threshold: the midpoint between the mean ratios of the target and of rejected texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapgate.llm.common import SPACE, chunks, flat, in_arrow, map_chunks, mix, prefix_sums, runs, substring_hashes

NGRAM_BYTES = 3
BUCKET_BITS = 16
SMOOTHING = 0.5
#: Where the threshold lies between the target mean (0) and the reject mean (1).
THRESHOLD_AT = 0.25
#: At most so many labelled rows make the target and reject multinomials.
FIT_ROWS = 16_384
MIN_WORDS = 50
MAX_REPEATED_PCT = 50
WINDOW_WORDS = 3
#: The symbols that count.
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


def buckets(data, offsets):
    """Hash bucket of each n-gram and the document it is in; n-grams stay in a document."""
    size = max(0, len(data) - NGRAM_BYTES + 1)
    code = np.zeros(size, np.uint32)
    for k in range(NGRAM_BYTES):
        code = (code << np.uint32(8)) | data[k:k + size]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)
    count = np.maximum(np.diff(offsets) - NGRAM_BYTES + 1, 0)
    owner = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(owner)) + (offsets[:-1] - (np.cumsum(count) - count))[owner]
    return code[at], owner


def ngram_counts(docs: DataFrame, text_col="text", kind_col="kind") -> DataFrame:
    """(bucket, raw, target, reject): n-gram counts of all texts and of those of kind 1 and 0."""
    def run(batches):
        sums = np.zeros((3, 1 << BUCKET_BITS), np.int64)
        for batch in chunks(batches, text_col):
            code, owner = buckets(*flat(batch.column(text_col)))
            kind = batch.column(kind_col).fill_null(-1).to_numpy(zero_copy_only=False)[owner]
            sums[0] += np.bincount(code, minlength=1 << BUCKET_BITS)
            for row, value in ((1, 1), (2, 0)):
                sums[row] += np.bincount(code[kind == value], minlength=1 << BUCKET_BITS)
        full = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(full), *(pa.array(x[full]) for x in sums)], ["bucket", "raw", "target", "reject"])

    parts = in_arrow(docs.select(text_col, kind_col), run, "bucket long, raw long, target long, reject long")
    return parts.groupBy("bucket").agg(*(F.sum(c).alias(c) for c in ("raw", "target", "reject")))


def fit(docs: DataFrame, text_col="text", kind_col="kind") -> tuple[np.ndarray, float]:
    """Log ratio per bucket and the threshold on the mean ratio.

    kind: 1 trusted, 0 rejected, anything else or null neither. Without trusted texts every
    ratio is 0; without rejected ones the reject mean is taken as far below the raw mean as the
    target mean lies above it. The model is ``2 ** BUCKET_BITS`` numbers.
    """
    size = 1 << BUCKET_BITS
    raw, target, reject = (np.zeros(size) for _ in range(3))
    for r in ngram_counts(docs, text_col, kind_col).collect():
        raw[r.bucket], target[r.bucket], reject[r.bucket] = r.raw, r.target, r.reject
    if not target.sum():
        return np.zeros(size), 0.0
    share = lambda x: (x + SMOOTHING) / (x.sum() + SMOOTHING * size)
    ratio = np.log(share(target)) - np.log(share(raw))
    mean = lambda x: float((ratio * x).sum() / max(x.sum(), 1))
    low = mean(reject) if reject.sum() else 2 * mean(raw) - mean(target)
    return ratio, mean(target) + THRESHOLD_AT * (low - mean(target))


def base_counts(data, offsets):
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    n = len(offsets) - 1
    starts, ends, doc = runs(~SPACE[data], offsets)
    per_doc = lambda at: np.bincount(np.searchsorted(offsets, at, "right") - 1, minlength=n)
    n_words = np.bincount(doc, minlength=n)
    chars = per_doc(np.flatnonzero(~SPACE[data] & ((data & 0xC0) != 0x80)))
    symbols = per_doc(np.flatnonzero(SYMBOLS[data]))

    sums = prefix_sums(data)
    word = substring_hashes(sums, starts, ends)
    repeated = np.zeros(len(starts), bool)
    if len(starts) >= WINDOW_WORDS:
        m = len(starts) - WINDOW_WORDS + 1
        window = np.zeros(m, np.uint64)
        for k in range(WINDOW_WORDS):
            window = mix(window * np.uint64(3) + word[k:k + m])
        inside = np.flatnonzero(doc[:m] == doc[WINDOW_WORDS - 1:])
        key = mix(window[inside] + doc[inside].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for k in range(WINDOW_WORDS):
            repeated[inside[twice] + k] = True
    n_repeat = np.bincount(doc[repeated], minlength=n)

    line_at, line_end, line_doc = runs(data != 10, offsets)
    holds = np.zeros(len(line_at), bool)
    if len(line_at):
        counted = np.concatenate([[0], np.cumsum(~SPACE[data])])
        holds = counted[line_end] > counted[line_at]
    line_at, line_end, line_doc = line_at[holds], line_end[holds], line_doc[holds]
    key = mix(substring_hashes(sums, line_at, line_end) + line_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    later = np.ones(len(key), bool)
    later[first] = False
    return n_words, chars, symbols, np.bincount(line_doc[later], minlength=n), n_repeat


def judge(docs: DataFrame, model, id_col="doc_id", text_col="text") -> DataFrame:
    """Base counts, ``base_failed``, the mean ratio and ``kept`` of each row.

    A null or empty text has no words and fails the base rules; a text shorter than an n-gram
    has ratio 0. Repeated rows are judged each.
    """
    ratio, threshold = model
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = rows.select("id", *(F.lit(0).cast("long").alias(c) for c in names), F.lit(True).alias("base_failed"),
                         F.lit(0.0).alias("llr"), F.lit(True).alias("kept")).schema
    table = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batch):
        data, offsets = flat(batch.column("text"))
        counts = base_counts(data, offsets)
        code, owner = buckets(data, offsets)
        n = len(offsets) - 1
        llr = np.bincount(owner, table.value[code], minlength=n) / np.maximum(np.bincount(owner, minlength=n), 1)
        failed = (counts[0] < MIN_WORDS) | (100 * counts[4] > MAX_REPEATED_PCT * counts[0])
        out = [batch.column("id"), *(pa.array(c.astype(np.int64)) for c in counts),
               pa.array(failed), pa.array(llr), pa.array(~failed & (llr >= threshold))]
        return pa.RecordBatch.from_arrays(out, schema.names)

    return map_chunks(rows, "text", schema, run).withColumnRenamed("id", id_col)


def quality_rules(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality", fit_rows=FIT_ROWS) -> DataFrame:
    """:func:`judge` with a model of ``docs`` itself, trusted and rejected texts being its labelled ones.

    At most ``fit_rows`` labelled ids count, by a hash of the id, so that they can be broadcast;
    the raw counts cover every document. An id with several labels takes the smallest.
    """
    kinds = (labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("int").alias("kind"))
             .where("kind in (0, 1)").orderBy(F.xxhash64("id"), "id").limit(fit_rows))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(kinds), "id", "left")
    return judge(docs, fit(rows), id_col, text_col)
