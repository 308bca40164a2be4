"""SentencePiece encoding and decoding by vectorised merge rounds.

The texts of a chunk become one flat array of characters, cut into words where no piece of the
vocabulary reaches across. Each distinct word is encoded once: all words' symbols lie in flat
arrays, a round finds the smallest pair rank of each word, merges its leftmost occurrences that
do not overlap, all words at once, and compacts the arrays; words without a pair are done.

Merging all occurrences in one round equals merging them one by one only if the merged piece
takes part in no pair of the same or a better rank. Where it does, a word merges one occurrence
a round, so the ids are those of the sentencepiece library in every case.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapgate.llm.common import MULTIPLIER, flat, map_chunks, mix

SPACE_MARK = 0x2581
NONE = np.int32(1 << 30)
_tables: dict[str, "Tables"] = {}


def vocabulary(model_path: str):
    """(piece, score, kind) of each id, read on the driver; kind is b byte, s special or n normal."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    kind = lambda i: "b" if sp.is_byte(i) else "s" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "n"
    return [(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.get_piece_size())]


class Tables:
    """Lookups of a vocabulary: characters, pairs and the bytes of each piece."""

    def __init__(self, pieces):
        ids = {p: i for i, (p, _, k) in enumerate(pieces) if k == "n"}
        order = sorted({s for _, s, k in pieces if k == "n"}, reverse=True)
        place = {s: r for r, s in enumerate(order)}
        rank = np.array([place.get(s, 0) for _, s, _ in pieces], np.int32)
        many = np.bincount([place[s] for p, s, k in pieces if k == "n" and len(p) > 1], minlength=len(order)) > 1
        self.byte_id = np.zeros(256, np.int64)
        self.text = []
        for i, (p, _, k) in enumerate(pieces):
            if k == "b":
                self.byte_id[int(p[3:5], 16)] = i
            self.text.append(bytes([int(p[3:5], 16)]) if k == "b" else b"" if k == "s" else p.replace(chr(SPACE_MARK), " ").encode())
        chars = sorted({c for p in ids for c in p})
        self.char = np.full(0x110000, 0, np.int32)
        self.char[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.symbol = np.array([-1, *(ids.get(c, -1) for c in chars)], np.int32)
        number = {c: i + 1 for i, c in enumerate(chars)}
        self.spans = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        self.unsafe = many[rank]
        keys, values = [], []
        for p, i in ids.items():
            for a, b in zip(p, p[1:]):
                self.spans[number[a], number[b]] = True
            for cut in range(1, len(p)):
                left, right = ids.get(p[:cut]), ids.get(p[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(i)
                    for part in (left, right):
                        if rank[part] >= rank[i] and len(pieces[part][0]) > 1:
                            self.unsafe[part] = True
        self.rank = rank
        self.bits = max(10, (8 * len(keys)).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.zeros(1 << self.bits, np.int32)
        todo, at = np.array(keys, np.int64), self._slot(np.array(keys, np.int64))
        todo_values = np.array(values, np.int32)
        while len(todo):
            free = self.keys[at] < 0
            _, first = np.unique(at, return_index=True)
            put = np.zeros(len(at), bool)
            put[first] = True
            put &= free
            self.keys[at[put]], self.values[at[put]] = todo[put], todo_values[put]
            todo, todo_values, at = todo[~put], todo_values[~put], (at[~put] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key):
        return ((key.astype(np.uint64) * MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merges(self, left, right):
        """Rank and id of the piece a pair makes; ``NONE`` where it makes none."""
        key = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = self._slot(key)
        found = self.keys[at]
        value = self.values[at]
        miss = np.flatnonzero((found != key) & (found >= 0))
        while len(miss):
            at[miss] = (at[miss] + 1) & ((1 << self.bits) - 1)
            found[miss], value[miss] = self.keys[at[miss]], self.values[at[miss]]
            miss = miss[(found[miss] != key[miss]) & (found[miss] >= 0)]
        hit = (found == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[value], NONE), value


def merge_words(tables: Tables, symbols, starts):
    """Symbols of all words after merging, and where each word's symbols begin, with the end."""
    n = len(starts)
    ends = np.append(starts[1:], len(symbols))
    word = np.repeat(np.arange(n), ends - starts)
    sym, done_sym, done_word = symbols.astype(np.int32), [], []
    rank, value = np.full(len(sym), NONE, np.int32), np.zeros(len(sym), np.int32)
    inner = np.flatnonzero(word[1:] == word[:-1])
    rank[inner], value[inner] = tables.merges(sym[inner], sym[inner + 1])
    while len(sym):
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        size = np.diff(np.append(first, len(sym)))
        low = np.minimum.reduceat(rank, first)
        least = np.repeat(low, size)
        over = least == NONE
        if over.any():
            done_sym.append(sym[over])
            done_word.append(word[over])
            if over.all():
                break
            live = ~over
            sym, word, rank, value, least = sym[live], word[live], rank[live], value[live], least[live]
        at = np.flatnonzero(rank == least)
        same_word = word[at[1:]] == word[at[:-1]]
        single = tables.unsafe[value[at]]
        # a word with one unsafe merge takes its leftmost pair only
        begin = np.flatnonzero(np.concatenate([[True], ~same_word]))
        single = np.repeat(np.logical_or.reduceat(single, begin), np.diff(np.append(begin, len(at))))
        leftmost = np.zeros(len(at), bool)
        leftmost[begin] = True
        # of pairs that overlap every second one goes, from the left
        new_run = np.concatenate([[True], ~(same_word & (at[1:] == at[:-1] + 1))])
        run = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
        at = at[np.where(single, leftmost, (np.arange(len(at)) - run) % 2 == 0)]
        sym[at] = value[at]
        stay = np.ones(len(sym), bool)
        stay[at + 1] = False
        moved = np.cumsum(stay) - 1
        at = moved[at]
        sym, word, rank, value = sym[stay], word[stay], rank[stay], value[stay]
        redo = np.unique(np.concatenate([at, at[at > 0] - 1]))
        last = len(sym) - 1
        edge = redo[(redo == last) | (word[np.minimum(redo + 1, last)] != word[redo])]
        rank[edge] = NONE
        redo = redo[(redo < last) & (word[np.minimum(redo + 1, last)] == word[redo])]
        rank[redo], value[redo] = tables.merges(sym[redo], sym[redo + 1])
    if not n:
        return np.zeros(0, np.int32), np.zeros(1, np.int64)
    sym, word = np.concatenate(done_sym), np.concatenate(done_word)
    sym = sym[np.argsort(word, kind="stable")]
    return sym, np.concatenate([[0], np.cumsum(np.bincount(word, minlength=n))])


def encode_words(tables: Tables, data, offsets):
    """Distinct words' ids, and which words each text is made of.

    Returns (ids of each distinct word as lists of arrays, word numbers of all texts, where each
    text's words begin). A text that is not empty begins with a space mark.
    """
    n = len(offsets) - 1
    head = (data & 0xC0) != 0x80
    count = np.concatenate([[0], np.cumsum(head)])[offsets]
    chars = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    length = np.diff(count)
    full = length > 0
    shift = np.cumsum(full)
    code = np.full(len(chars) + int(full.sum()), SPACE_MARK, np.uint32)
    owner = np.repeat(np.arange(n), length)
    code[np.arange(len(chars)) + shift[owner]] = chars
    code[code == 32] = SPACE_MARK
    size = length + full
    begins = np.cumsum(size) - size
    c = tables.char[code]
    cut = np.ones(len(code), bool)
    mark = code == SPACE_MARK
    cut[1:] = ~tables.spans[c[:-1], c[1:]] | (mark[1:] & ~mark[:-1])
    cut[begins[full]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(code))
    h = np.zeros(len(starts), np.uint64)
    if len(starts):
        spread = mix(code.astype(np.uint64) + np.uint64(77))
        within = np.arange(len(code)) - np.repeat(starts, ends - starts)
        h = mix(np.add.reduceat(mix(spread + within.astype(np.uint64) * MULTIPLIER), starts) + (ends - starts).astype(np.uint64))
    _, first, number = np.unique(h, return_index=True, return_inverse=True)
    a, b = starts[first], ends[first]
    sizes = b - a
    word_starts = np.cumsum(sizes) - sizes
    take = np.repeat(a - word_starts, sizes) + np.arange(int(sizes.sum()))
    symbols, at = merge_words(tables, np.where(c[take] > 0, tables.symbol[c[take]], -1), word_starts)
    # a character without a piece stands as -1 and is a word of its own, or one of a word that has none
    ids = [None] * len(first)
    bounds = at.tolist()
    missing = np.zeros(len(first), bool)
    if len(symbols):
        missing = np.minimum.reduceat(symbols, at[:-1]) < 0
    listed = symbols.tolist()
    for w in range(len(first)):
        ids[w] = listed[bounds[w]:bounds[w + 1]]
    for w in np.flatnonzero(missing).tolist():
        plain = iter(code[a[w]:b[w]].tolist())
        out = []
        for s in ids[w]:
            if s < 0:
                out += tables.byte_id[list(chr(next(plain)).encode())].tolist()
            else:
                out.append(s)
                for _ in range(len(tables.text[s].decode())):
                    next(plain)
        ids[w] = out
    texts = np.searchsorted(starts, np.append(begins, len(code)))
    return ids, number.ravel(), texts


def decode_ids(tables: Tables, ids) -> bytes:
    """UTF-8 text of ids: pieces joined, marks as spaces, the first space dropped; bad bytes become U+FFFD."""
    raw = b"".join(tables.text[i] for i in ids)
    return raw.removeprefix(b" ").decode("utf-8", "replace").encode()


def tables_of(key: str, shared) -> Tables:
    """Tables of a broadcast vocabulary, built once in each worker."""
    if key not in _tables:
        _tables.clear()
        _tables[key] = Tables(shared.value)
    return _tables[key]


def encode(docs: DataFrame, model_path: str, id_col="doc_id", text_col="text", with_ids=True) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, ids]) of each row; no begin or end ids.

    A null text is empty and has no ids. Repeated rows come out repeated.
    """
    pieces = vocabulary(model_path)
    key = hashlib.sha256(repr(pieces).encode()).hexdigest()
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    extra = [F.array().cast("array<int>").alias("ids")] if with_ids else []
    schema = rows.select("id", F.lit(0).cast("long").alias("n_tokens"), F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256"), *extra).schema

    def run(batch):
        tables = tables_of(key, shared)
        words, number, texts = encode_words(tables, *flat(batch.column("text")))
        listed = ["," + ",".join(map(str, w)) for w in words]
        # a word's bytes are whole characters, so that words are decoded apart
        plain = [b"".join([tables.text[i] for i in w]) for w in words]
        size = np.array([len(w) for w in words], np.int64)
        total = np.concatenate([[0], np.cumsum(size[number])])[texts]
        number, texts = number.tolist(), texts.tolist()
        by_ids, by_text, ids = [], [], []
        for a, b in zip(texts, texts[1:]):
            mine = number[a:b]
            by_ids.append(hashlib.sha256("".join([listed[w] for w in mine])[1:].encode()).hexdigest())
            by_text.append(hashlib.sha256(b"".join([plain[w] for w in mine]).removeprefix(b" ")).hexdigest())
            if with_ids:
                ids.append([i for w in mine for i in words[w]])
        out = [batch.column("id"), pa.array(np.diff(total)), pa.array(by_ids, pa.string()), pa.array(by_text, pa.string())]
        return pa.RecordBatch.from_arrays(out + ([pa.array(ids, pa.list_(pa.int32()))] if with_ids else []), schema.names)

    return map_chunks(rows, "text", schema, run).withColumnRenamed("id", id_col)
