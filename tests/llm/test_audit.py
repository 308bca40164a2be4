"""Decontamination, divergence and fill-in-middle against brute force, and their edge cases."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from snapgate.llm import common, decontaminate, divergence, middle, queries

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {i: i + 32 for i in range(65, 91)}
DOCS = "doc_id long, text string, lang string, source string, n_words string, n string, items string, row string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", "w", "n", "i", "r") for i, t in rows], DOCS)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, doc_id string")


def words(text):
    return WORDS.findall((text or "").translate(UPPER))


def brute_hits(docs, bench, size=10):
    windows = collections.defaultdict(set)
    for item, text in bench:
        w = words(text)
        for i in range(max(len(w) - size + 1, min(len(w), 1))):
            windows[tuple(w[i:i + size])].add(item)
    out = []
    for key, text in docs:
        w, hit, items = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i:i + n]))
                if found is not None:
                    hit.update(range(i, i + n))
                    items |= found
        out.append((key, len(w), len(hit), sorted(str(i) for i in items if i is not None)))
    return sorted(out, key=repr)


def cases(seed=5):
    rng = random.Random(seed)
    vocab = ["a", "B", "9", "é", "Zo", "ñandú", "x1"]
    gaps = [" ", "  ", ", ", "\n", "\u0000", "-", " ... "]

    def text(n):
        return "".join(rng.choice(vocab) + rng.choice(gaps) for _ in range(n))
    bench = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(40)] + [(90, None), (91, "!?"), (92, "one two"), (None, "red fox")]
    bench += [bench[3], (93, bench[4][1]), (94, " ".join(f"w{i}" for i in range(9000)))]
    docs = [(i, text(rng.choice([0, 5, 60, 300]))) for i in range(60)]
    docs += [(100 + i, f"{text(7)} {t or ''} {text(3)}{t or ''}") for i, (_, t) in enumerate(bench)]
    docs += [(None, None), (None, None), (1, ""), (3, "One, TWO"), (3, "One, TWO"), (4, "the red-fox ran"), (5, "one " * 700_000)]
    return docs, bench


@pytest.mark.parametrize("block", [1 << 24, 20_000])
def test_decontaminate_equals_brute_force(spark, block):
    docs, bench = cases()
    frame, items = docs_of(spark, docs), items_of(spark, [(i, t, "x") for i, t in bench])
    found = decontaminate.contamination(frame, items, block_bytes=block)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()), key=repr) == brute_hits(docs, bench)
    clean = decontaminate.remove_spans(frame, items, block_bytes=block)
    assert clean.columns == frame.columns
    kept = collections.Counter((r.doc_id, r.text) for r in clean.collect())
    spans = decontaminate.contamination(frame, items, ["doc_id", "text"], block_bytes=block).collect()
    for r in spans:
        chars, at = r.text or "", 0
        out = ""
        for s in r.spans:
            out, at = out + chars[at:s.start], s.end
        kept[r.doc_id, None if r.text is None else out + chars[at:]] -= 1
    assert not any(kept.values())
    dropped = decontaminate.drop_contaminated(frame, items, block_bytes=block)
    assert dropped.columns == frame.columns
    assert sorted((r.doc_id for r in dropped.collect()), key=repr) == sorted((d for d, _, n, _ in brute_hits(docs, bench) if not n), key=repr)


def test_decontaminate_names_and_empty_tables(spark):
    docs, bench = docs_of(spark, [(1, "a b c")]), items_of(spark, [(1, "b", "x")])
    out = decontaminate.contamination(docs, bench, docs.columns)
    assert out.columns == [*docs.columns, "n_words_", "n_hit", "items_", "spans"]
    assert [(r.n_words, r.n_words_, r.items, r.items_, [tuple(s) for s in r.spans]) for r in out.collect()] == [("w", 3, "i", ["1"], [(2, 3)])]
    assert decontaminate.contamination(docs.limit(0), bench).collect() == []
    assert [(r.n_words, r.n_hit) for r in decontaminate.contamination(docs, bench.limit(0)).collect()] == [(3, 0)]
    assert decontaminate.remove_spans(docs, bench.limit(0)).first().text == "a b c"


def test_windows_of_one_hash_stay_apart(monkeypatch):
    """With a hash of two values every window meets others' hashes; bytes decide."""
    coarse = lambda sums, a, b: common.substring_hashes(sums, a, b) & np.uint64(1)
    monkeypatch.setattr(decontaminate, "substring_hashes", coarse)
    table = decontaminate.table_of([("x", b"a b c d"), ("y", b"b c e"), ("z", b"q")], 2)
    raw = b"c d b e a q b c"
    w = decontaminate.words_of(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    hit, items = decontaminate.scan(w, table, 1)
    assert hit.tolist() == [True, True, False, False, False, True, True, True] and items == [["x", "y", "z"]]


# -- divergence

def brute_divergence(rows, least=10):
    langs = collections.defaultdict(lambda: collections.defaultdict(collections.Counter))
    seen = collections.defaultdict(collections.Counter)
    for text, lang, source in rows:
        found = TERMS.findall((text or "").translate(UPPER))
        langs[lang or ""][source or ""].update(found)
        seen[lang or ""].update(set(found))
    out = []
    for lang, groups in langs.items():
        kept = [t for t, n in seen[lang].items() if n >= least]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}
        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), collections.Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in groups if o != s]
            term = [(-f(p[s][t], q[t]), t) for t in kept if groups[s][t] > 0 and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:10])):
                out += [(lang, s, part, item, -v, k + 1) for k, (v, item) in enumerate(items)]
    return sorted(out)


def test_divergence_equals_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    vocab = ["the", "The", "é", "ñu", "zeta", "\U0001d11e", "ab", "q", *(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(150))]
    rows = []
    for i in range(400):
        source = rng.choice(["s1", "s2", "s3", None, "", "S1"])
        own = vocab[:40] if source == "s1" else vocab
        text = " ".join(own[min(int(rng.expovariate(0.05)), len(own) - 1)] for _ in range(rng.choice([0, 3, 40])))
        rows.append((text, rng.choice(["en", "en", "de", None]), source))
    rows += [(None, "en", "only nulls"), ("12 !", "xx", "a"), ("few words", "xx", "b"), ("x " * 1_200_000, "en", "s2"), *rows[:30]]
    docs = spark.createDataFrame([(*r, "t", 1) for r in rows], "text string, lang string, source string, term string, n int").repartition(5)
    expected = brute_divergence(rows)
    assert sorted(map(tuple, divergence.divergence(docs).collect())) == expected
    assert divergence.divergence(docs.limit(0)).collect() == []


def test_divergence_in_small_parts():
    """The index scattered in parts of any size sums to the same accumulators."""
    rng = np.random.default_rng(3)
    size = rng.integers(1, 9, 200)
    source = np.concatenate([np.sort(rng.choice(9, s, replace=False)) for s in size])
    p0 = np.arange(9) * 3 + 5
    p = p0[source] + rng.integers(1, 10**9, len(source))
    term = np.repeat(np.arange(200), size)
    expected = collections.Counter()
    f = lambda a, b: (a - b) ** 2 // (a + b)
    for i in range(len(p)):
        for j in range(i + 1, len(p)):
            if term[i] == term[j]:
                a, b, c, d = (int(x) for x in (p[i], p[j], p0[source[i]], p0[source[j]]))
                expected[int(source[i]), int(source[j])] += f(a, b) - f(a, d) - f(c, b) + f(c, d)
    for parts in (1, 7):
        found = collections.Counter()
        for part in np.array_split(np.arange(200), parts):
            pick = np.isin(term, part)
            last = np.repeat(np.cumsum(size[part]), size[part])
            for a, b, v in zip(*divergence.scatter(np.arange(pick.sum()) + 1, last, source[pick], p[pick], p0[source[pick]], 9)):
                found[int(a), int(b)] += int(v)
        assert found == expected


def test_shares_are_exact_beyond_64_bits(spark):
    n, total, kept = 10**17 + 7, 3 * 10**17, 12345
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(kept))).first()[0]
    assert got == 1 + 10**9 * (n + 2) // (total + 2 * kept)


# -- fill-in-middle

def brute_middle(key, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]
    a, b = sorted(x % (len(tokens) + 1) for x in h[:2])
    p, m, s = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return key, len(tokens), "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    return key, len(tokens), form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


def test_middle_equals_brute_force(spark):
    rng = random.Random(2)
    parts = ["ab", "Z", " ", "\n", "<", "P", ">", "S", "M", "é", "\U0001d11e", "\u0000", "9", "é"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.choice([0, 1, 2, 9, 80])))) for i in range(300)]
    rows += [(1, None), (None, None), (None, "a b"), (7, "x<M>y"), (8, "<S"), (9, "<P"), (9, "<P"), (-3, "word " * 600_000), (2, "--" * 40_000)]
    docs = docs_of(spark, rows)
    out = middle.fill_in_middle(docs)
    back = out.withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in back), key=repr) \
        == sorted((brute_middle(*r) for r in rows), key=repr)
    assert sorted((r.doc_id, r.back) for r in back if r.doc_id is not None) == sorted((i, t or "") for i, t in rows if i is not None)
    assert {"psm", "spm", "plain"} == {r.form for r in back}
    assert middle.fill_in_middle(docs, carry=docs.columns).columns == [*docs.columns, "n_", "form", "prefix_chars", "middle_chars", "output"]
    assert middle.fill_in_middle(docs.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["op11_decontaminate", "op12_divergence", "op13_middle"])
def test_registered_query_equals_its_sql(spark, name):
    from oracle import compare, connect
    sf = "/root/testdata/sf0.001"
    equal, message = compare(connect(sf), queries.QUERIES[name](spark, sf), queries.SQL[name])
    assert equal, message
