"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols: I (insult), V (threat), T (target), N (negation), R (reported speech) and
o (other). Insult words are a lexicon learned from labels: beginnings of words and whole words
that toxic texts hold far more often than clean ones, with their log-odds as weight. The other
symbols are the short lists below. Five small weighted transducers read a clause: negation,
reported speech and target mark the symbols in their reach, threat joins a threat with its target,
insult writes the form of each match. They are composed into one table, which runs over the
clauses; an arc's weight is the product of the five arcs it is made of.
A text is scored by a logistic model over the weights its matched clauses have by form, so an
isolated word counts only through the clause it matches in.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, functions as F

from snapgate.llm.common import chunks, flat, in_arrow, keep, map_chunks, prefix_sums, runs, substring_hashes

#: At most so many labelled rows, in the order of a hash of the id, train the model.
FIT_ROWS = 8192
PENALTY = 1e-4
#: Bytes of the word beginnings that may be lexicon entries; whole words come on top.
PREFIXES = (3, 4, 5, 6, 7, 8)
#: An entry is in so many toxic texts; its log-odds less so many standard errors are its weight.
MIN_DOCS, ERRORS, MIN_WEIGHT = 4, 1.64, 1.0

# The closed classes of the grammar.
TARGETS = ("you your yours yourself u ur he she they him her them his their people "
           "du dich dir ihr euch sie er tu te toi vous ton votre il ils usted tú ustedes él ella ellos").split()
NEGATIONS = "not no never nobody none isn't aren't wasn't don't nicht kein keine nie ne pas jamais nunca jamás".split()
REPORTS = ("said says say called calls wrote writes quoted quote claimed claims told "
           "sagte sagt schrieb dit disait écrit dijo dice escribió").split()
THREATS = ("kill hurt destroy shoot stab burn beat punch hang murder "
           "töten umbringen schlagen tuer frapper brûler matar golpear quemar").split()

FORMS = ("plain", "aimed", "negated", "reported", "threat")
INPUTS = "oIVTNR"
#: What the composed table writes: nothing, a match's form, or that a target follows the last plain insult.
OUTPUTS = ("", *FORMS, "late")

# Weights of arcs, by the words since the mark where there are several.
NEGATED, AIMED, THREATENED = (0.4, 0.6, 0.8), (1.6, 1.4, 1.2), (1.6, 1.4, 1.2)
REPORTED, LATE = 0.5, 1.3

# A transducer: {(state, symbol): (next state, symbol written, weight)}; its first state is 0. A
# symbol without an arc is written as it is, and leads where the state's arc for None does, or stays.


def _reach(marks, symbols, weights):
    """A transducer that marks symbols up to so many words behind one of ``marks``."""
    arcs = {(0, m): (1, m, 1.0) for m in marks}
    for state, weight in enumerate(weights, 1):
        then = (state + 1) % (len(weights) + 1)
        arcs |= {(state, None): (then, None, 1.0)} | {(state, m): (1, m, 1.0) for m in marks}
        arcs |= {(state, s): (then, out, weight) for s, out in symbols.items()}
    return arcs


#: Negated insults and threats.
NEGATION = _reach("N", {"I": "In", "V": "Vn"}, NEGATED)
#: All that follows a word of reported speech in its clause.
REPORT = {(0, "R"): (1, "R", 1.0), (1, "I"): (1, "Ir", REPORTED), (1, "V"): (1, "Vr", 1.0), (1, "T"): (1, "Tr", REPORTED)}
#: Insults and threats behind their target.
TARGET = _reach(("T", "Tr"), {"I": "Ia", "V": "Va", "Vr": "Vra"}, AIMED)


def _threat(weights):
    """A threat matches behind its target, or waits so many words for one."""
    arcs = {}
    for state in range(len(weights) + 1):
        arcs |= {(state, "V"): (1, "o", 1.0), (state, "Vr"): (1, "o", 1.0), (state, "Vn"): (0, "o", 1.0),
                 (state, "Va"): (0, "threat", 1.0), (state, "Vra"): (0, "reported", REPORTED)}
        if state:
            arcs |= {(state, None): ((state + 1) % (len(weights) + 1), None, 1.0),
                     (state, "T"): (0, "threat", weights[state - 1]), (state, "Tr"): (0, "reported", weights[state - 1])}
    return arcs


THREAT = _threat(THREATENED)
#: Forms of the matches; in state 1 the last match is a plain insult, which a target may follow.
INSULT = {(state, symbol): arc for state in (0, 1) for symbol, arc in {
    "I": (1, "plain", 1.0), "Ia": (0, "aimed", 1.0), "In": (0, "negated", 1.0), "Ir": (0, "reported", 1.0),
    "threat": (0, "threat", 1.0), "reported": (0, "reported", 1.0)}.items()} | {
    (1, "T"): (0, "late", LATE), (1, "Tr"): (0, "late", LATE)}
MACHINES = (NEGATION, REPORT, TARGET, THREAT, INSULT)


def step(machine, state, symbol):
    """(next state, symbol written, weight) of one transducer."""
    if (state, symbol) in machine:
        return machine[state, symbol]
    return machine.get((state, None), (state, None, 1.0))[0], symbol, 1.0


def compose(first, second, alphabet):
    """The transducer that writes what ``second`` writes of what ``first`` writes of the alphabet.

    States are pairs, numbered as they are reached. The result has every arc.
    """
    number, arcs, left = {(0, 0): 0}, {}, [(0, 0)]
    while left:
        a, b = pair = left.pop()
        for symbol in alphabet:
            a_next, middle, w1 = step(first, a, symbol)
            b_next, out, w2 = step(second, b, middle)
            if (a_next, b_next) not in number:
                number[a_next, b_next] = len(number)
                left.append((a_next, b_next))
            arcs[number[pair], symbol] = number[a_next, b_next], out, w1 * w2
    return arcs


def composed(machines=MACHINES):
    """All transducers as one table: lists of next state, output's place in OUTPUTS and weight, by state * inputs + input."""
    one = machines[0]
    for machine in machines[1:]:
        one = compose(one, machine, INPUTS)
    order = [one[key] for key in itertools.product(range(len(one) // len(INPUTS)), INPUTS)]
    place = {name: i for i, name in enumerate(OUTPUTS)}
    return ([n * len(INPUTS) for n, _, _ in order], [place.get(out, 0) for _, out, _ in order], [w for _, _, w in order])


_word = np.zeros(256, bool)
_word[[*range(48, 58), *range(97, 123), 95, 39, *range(128, 256)]] = True
_stop = np.isin(np.arange(256), np.frombuffer(b".!?;:\n", np.uint8))


def _hash_words(words):
    out = []
    for w in words:
        data = np.frombuffer(w.encode(), np.uint8)
        out.append(int(substring_hashes(prefix_sums(data), np.array([0]), np.array([len(data)]))[0]))
    return out


def _tokens(batch):
    """Lower-cased bytes, word bounds, documents and hash sums of a batch's texts."""
    text = pc.utf8_lower(batch.column("text"))
    data, offsets = flat(text)
    starts, ends, doc = runs(_word[data], offsets)
    return data, offsets, starts, ends, doc, prefix_sums(data)


def _grams(starts, ends, sums):
    """Hashes of each word's beginnings, and of the whole word; 0 where there is none."""
    length = ends - starts
    for size in PREFIXES:
        at = np.flatnonzero(length >= size)
        yield at, substring_hashes(sums, starts[at], starts[at] + size)
    yield np.arange(len(starts)), ~substring_hashes(sums, starts, ends)


def _gram_docs(batch):
    """How many toxic and clean texts of the batch hold each gram."""
    _, _, starts, ends, doc, sums = _tokens(batch)
    toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
    grams, owners = [], []
    for at, h in _grams(starts, ends, sums):
        grams.append(h)
        owners.append(doc[at])
    gram, owner = np.concatenate(grams), np.concatenate(owners)
    order = np.lexsort((owner, gram))
    gram, owner = gram[order], owner[order]
    once = np.concatenate([[True], (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])])[:len(gram)]
    gram, owner = gram[once], owner[once]
    values, at = np.unique(gram, return_index=True)
    hit = np.add.reduceat(toxic[owner].astype(np.int64), at) if len(at) else np.zeros(0, np.int64)
    total = np.diff(np.append(at, len(gram)))
    return pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(hit), pa.array(total - hit)], ["gram", "toxic", "clean"])


def lexicon(rows: DataFrame) -> dict[int, float]:
    """Hash of each entry with its log-odds, from rows (text, toxic) of any number.

    Counts and standard errors alone decide; every entry is in ``MIN_DOCS`` toxic training texts.
    """
    n = rows.groupBy("toxic").count().collect()
    n1, n0 = (sum(r["count"] for r in n if r.toxic == v) for v in (1, 0))
    if not n1 or not n0:
        return {}
    docs = (map_chunks(rows, "text", "gram long, toxic long, clean long", _gram_docs)
            .groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))
    odds = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((F.col("clean") + 0.5) / (n0 + 1))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    found = (docs.where(F.col("toxic") >= MIN_DOCS)
             .select("gram", (odds - ERRORS * error).alias("weight")).where(F.col("weight") >= MIN_WEIGHT))
    return {r.gram: r.weight for r in found.collect()}


class Grammar:
    """Symbols of words, and the composed table that runs over clauses."""

    def __init__(self, entries: dict[int, float]):
        self.table = composed()
        self.keys = np.array(sorted(entries), np.int64)
        self.weights = np.array([entries[k] for k in self.keys.tolist()])
        listed = [(h, s) for s, words in (("T", TARGETS), ("N", NEGATIONS), ("R", REPORTS), ("V", THREATS)) for h in _hash_words(words)]
        listed = dict(listed)
        self.listed = np.array(sorted(listed), np.uint64)
        self.symbols = np.array([INPUTS.index(listed[k]) for k in self.listed.tolist()], np.uint8)
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.keys.view(np.uint64) & np.uint64(0xFFFFF)] = True

    def insults(self, starts, ends, sums):
        """Weight of each word: the largest of its entries."""
        weight = np.zeros(len(starts))
        if not len(self.keys):
            return weight
        for at, h in _grams(starts, ends, sums):
            maybe = self.sieve[h & np.uint64(0xFFFFF)]
            at, h = at[maybe], h[maybe].view(np.int64)
            place = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = self.keys[place] == h
            np.maximum.at(weight, at[hit], self.weights[place[hit]])
        return weight

    def features(self, batch) -> np.ndarray:
        """For each text: weight of matched clauses by form, matches, largest clause, words."""
        data, offsets, starts, ends, doc, sums = _tokens(batch)
        n = len(offsets) - 1
        out = np.zeros((n, len(FORMS) + 3))
        out[:, -1] = np.bincount(doc, minlength=n)
        weight = self.insults(starts, ends, sums)
        whole = substring_hashes(sums, starts, ends)
        place = np.minimum(np.searchsorted(self.listed, whole), len(self.listed) - 1)
        symbol = np.zeros(len(starts), np.uint8)
        hit = self.listed[place] == whole
        symbol[hit] = self.symbols[place[hit]]
        symbol[(symbol == 0) & (weight > 0)] = 1
        stops = np.concatenate([[0], np.cumsum(_stop[data])])
        clause = stops[starts]
        new = np.concatenate([[True], (clause[1:] != clause[:-1]) | (doc[1:] != doc[:-1])])[:len(starts)]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts))
        number = np.cumsum(new) - 1
        heads = np.unique(number[(symbol == INPUTS.index("I")) | (symbol == INPUTS.index("V"))])
        for c in heads.tolist():
            a, b = int(first[c]), int(last[c])
            forms = match(symbol[a:b].tolist(), weight[a:b].tolist(), self.table)
            row = out[doc[a]]
            for form, w in forms:
                row[FORMS.index(form)] += w
                row[-3] += 1
            row[-2] = max(row[-2], sum(w for _, w in forms))
        return out


def match(symbols, weights, table) -> list[tuple[str, float]]:
    """(form, weight) of each match of a clause, by the composed table.

    symbols: places in INPUTS; weights: those of the insult words.
    """
    then, output, arc = table
    state, out, insult = 0, [], INPUTS.index("I")
    for s, w in zip(symbols, weights, strict=True):
        at = state + s
        state = then[at]
        if output[at]:
            form = OUTPUTS[output[at]]
            if form == "late":
                out[-1] = "aimed", out[-1][1] * arc[at]
            else:
                out.append((form, arc[at] * w if s == insult else arc[at]))
    return out


def _inputs(features):
    """Model inputs: log sums by form, density, matches, largest clause; all zero without a match."""
    words = np.maximum(features[:, -1:], 1)
    total = features[:, :len(FORMS)].sum(1, keepdims=True)
    return np.hstack([np.log1p(features[:, :len(FORMS)]), np.log1p(total), np.log1p(100 * total / words),
                      np.log1p(features[:, -3:-2]), np.log1p(features[:, -2:-1])])


def training_rows(docs: DataFrame, labels: DataFrame, id_col, text_col, label_col, fit_rows) -> DataFrame:
    """(text, toxic) of at most ``fit_rows`` labelled ids, each text once.

    Labels of ids whose crc32 modulo 5 is 0 are held out. An id with several labels takes the
    largest, a null label counts as none.
    """
    chosen = (labels.where(f"`{id_col}` is not null and `{label_col}` is not null and crc32(cast(`{id_col}` as string)) % 5 <> 0")
              .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("toxic"))
              .where("toxic in (0, 1)").orderBy(F.xxhash64("id"), "id").limit(fit_rows))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.join(F.broadcast(chosen), "id").groupBy("text").agg(F.max("toxic").alias("toxic"))


def fit(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", fit_rows=FIT_ROWS):
    """(lexicon, model weights). Without labels of both kinds every score is 0.

    The model's features are stored and summed by tasks, however many texts share an id.
    """
    rows = keep(training_rows(docs, labels, id_col, text_col, label_col, fit_rows))
    entries = lexicon(rows)
    if not entries:
        return {}, None
    grammar = Grammar(entries)

    def run(batches):
        for batch in chunks(batches, "text"):
            x = _inputs(grammar.features(batch))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column("toxic")], ["x", "toxic"])

    found = keep(in_arrow(rows, run, "x array<double>, toxic int"))
    model = LogisticRegression(regParam=PENALTY, maxIter=200, tol=1e-9).fit(
        found.select(array_to_vector("x").alias("features"), F.col("toxic").cast("double").alias("label")))
    return entries, np.round([*model.coefficients, model.intercept], 6)


def with_score(docs: DataFrame, model, text_col="text", out="score") -> DataFrame:
    """All columns and a score from 0 to 1; a null text is empty, an empty one matches nothing."""
    entries, weights = model
    schema = docs.select("*", F.lit(0.0).alias(out)).schema
    shared = docs.sparkSession.sparkContext.broadcast(Grammar(entries))

    def run(batch):
        if weights is None:
            score = np.zeros(batch.num_rows)
        else:
            texts = pa.RecordBatch.from_arrays([pc.fill_null(batch.column(text_col), "")], ["text"])
            x = _inputs(shared.value.features(texts))
            score = 1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30)))
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, out])

    return map_chunks(docs, text_col, schema, run)


def toxicity(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", fit_rows=FIT_ROWS) -> DataFrame:
    """(id, held_out, score, predicted) of each row.

    A null text is empty and scores like every text without a match. A null id is not held out.
    Repeated rows come out repeated with one score; an empty table gives no rows. Without labels of
    both kinds every score is 0.
    """
    model = fit(docs, labels, id_col, text_col, label_col, fit_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return with_score(rows, model).select(
        F.col("id").alias(id_col), F.expr("coalesce(crc32(cast(id as string)) % 5 = 0, false)").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
