"""Secret scans by a trigram inverted index, in DataFrame expressions only.

Each rule's regular expression gives a Boolean query of trigrams that any match must hold. An
index of postings (trigram, text hash) is made of those trigrams alone; intersecting postings
gives the texts that may match a rule, and only there the expression runs. Rules without
mandatory trigrams scan every text. Postings are joined by the hash of the text and a part of 64
that hangs on the row's other columns, so copies of one text are dealt over many tasks and a
colliding hash can add a candidate but lose none. Every expression takes time in proportion to
the text, whatever it holds.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from snapgate.llm.common import fresh

try:
    from re import _constants as _c, _parser as _p
except ImportError:  # before Python 3.11
    import sre_constants as _c
    import sre_parse as _p


@dataclass(frozen=True)
class Rule:
    """A regular expression; matches whose group has under ``least`` characters are dropped."""
    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    #: The same matches but for those ``least`` drops, where an expression can say so.
    find: str | None = None

    @property
    def finds(self) -> str:
        return self.find or self.pattern


# The base kinds, in the order in which ties of spans are listed.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    # a match runs to the end of its characters, so none within a dropped one is longer
    Rule("access", r"AKIA[A-Z0-9]+", 16, find=r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]+", 32, find=r"[0-9a-f]{32,}"),
)
# Public formats of further credentials.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("pay_key", r"[sr]k_live_[0-9A-Za-z]{16,}"),
    # begins where its run of characters does, and a scheme has 31 at most: else long runs take quadratic time
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{0,30}://[^/\s:@]++:[^/\s:@]++@"),
)
RULES = BASE + MORE

#: A set of alternatives larger than this ends a run of mandatory characters.
MAX_STRINGS = 16


def _strings(items) -> tuple[list[set[str]], set[str]]:
    """Finished sets of alternatives of a sequence, one string of each set being mandatory, and the open one."""
    done, now = [], {""}
    for op, arg in items:
        if op is _c.LITERAL:
            options = {chr(arg).lower()}
        elif op is _c.IN and all(o is _c.LITERAL for o, _ in arg):
            options = {chr(a).lower() for _, a in arg}
        elif op is _c.SUBPATTERN:
            inner, options = _strings(arg[3])
            if inner:
                done += [now, *inner]
                now = {""}
        elif op is _c.BRANCH:
            parts = [_strings(b) for b in arg[1]]
            options = set().union(*(o for inner, o in parts)) if not any(inner for inner, _ in parts) else None
        elif op is _c.MAX_REPEAT and arg[:2] == (0, 1):
            inner, options = _strings(arg[2])
            options = None if inner else options | {""}
        elif op is _c.MAX_REPEAT and arg[0] > 0:
            inner, options = _strings(arg[2])
            done += inner
            options = None
        else:
            options = None
        if options is None or len(now) * len(options) > MAX_STRINGS:
            done.append(now)
            now = {""} if options is None or len(options) > MAX_STRINGS else options
        else:
            now = {a + b for a in now for b in options}
    return done, now


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """All of these must hold, each of which is any of several sets of trigrams that occur together.

    Of lower-cased text. An empty list: no trigram is mandatory.
    """
    done, now = _strings(_p.parse(pattern))
    query = []
    for options in [*done, now]:
        sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in options}
        if options and frozenset() not in sets:
            query.append(sorted(sets, key=sorted))
    return query


#: Parts among which the copies of one text are dealt.
PARTS = 64


def _place(docs: DataFrame, text_col: str) -> list[Column]:
    """The hash of a row's text and its part, by the row's other columns."""
    others = [F.col(f"`{f.name}`") for f in docs.schema.fields if f.name != text_col and "map<" not in f.dataType.simpleString()
              and f.dataType.simpleString() != "variant"]
    part = F.pmod(F.xxhash64(*others), F.lit(PARTS)) if others else F.lit(0).cast("long")
    return [F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), part]


def postings(docs: DataFrame, text_col: str, trigrams: list[str]) -> DataFrame:
    """(hash, part, trigram): the number of each listed trigram that a text holds, with the text's place."""
    hash_, part = _place(docs, text_col)
    low = F.lower(F.coalesce(F.col(text_col), F.lit("")))
    # a column of its own, or the text would be lowered once for each trigram
    rows = docs.select(hash_.alias("hash"), part.alias("part"), low.alias("low"))
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(i)) for i, t in enumerate(trigrams))))
    return rows.select("hash", "part", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, text_col: str, rules) -> DataFrame:
    """(hash, part, rules): for each text that may match a rule, the rules as a bit set."""
    queries = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    trigrams = sorted({t for q in queries.values() for any_ in q for s in any_ for t in s})
    number = {t: i for i, t in enumerate(trigrams)}
    words = [f"w{k}" for k in range((len(trigrams) + 62) // 63)]
    # postings of a text meet in its task before the shuffle, as bits
    sets = postings(docs, text_col, trigrams).groupBy("hash", "part").agg(
        *(F.bit_or(F.expr(f"if(trigram div 63 = {k}, shiftleft(1L, cast(trigram % 63 as int)), 0L)")).alias(w) for k, w in enumerate(words)))

    def holds(trigram_set) -> Column:
        out = F.lit(True)
        for k, w in enumerate(words):
            need = sum(1 << (number[t] % 63) for t in trigram_set if number[t] // 63 == k)
            if need:
                out = out & (F.col(w).bitwiseAND(F.lit(need)) == need)
        return out

    bits = F.lit(0).cast("long")
    for i, query in queries.items():
        if query:
            every = F.lit(True)
            for any_ in query:
                some = F.lit(False)
                for s in any_:
                    some = some | holds(s)
                every = every & some
            bits = bits.bitwiseOR(F.when(every, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return sets.select("hash", "part", bits.alias("rules")).where("rules <> 0")


_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _matches(text: Column, number: int, rule: Rule) -> Column:
    """Spans of a rule: the text between matches and the matches give the places, in code points."""
    whole = F.regexp_extract_all(text, F.lit(rule.finds), F.lit(0))
    zipped = F.arrays_zip(F.split(text, rule.finds, -1).alias("gap"), whole.alias("whole"))

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["whole"])
        span = F.struct(start.alias("start"), F.lit(number).alias("kind"), end.alias("end"))
        # a match alone matches as it does in its text, so its group is taken from it
        part = F.regexp_extract(x["whole"], rule.finds, rule.group) if rule.group else x["whole"]
        out = F.when(F.length(part) >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.when(x["whole"].isNull(), acc).otherwise(F.struct(end.alias("at"), out.alias("out")))

    return F.aggregate(zipped, F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out")), step, lambda acc: acc["out"])


def _needs(rule: Rule) -> str:
    """A cheaper test of rules that scan fully: a class repeated ``least`` times."""
    return rule.finds.replace(",}", "}")


def with_spans(docs: DataFrame, text_col="text", out="spans", rules=RULES) -> DataFrame:
    """All columns and the spans (start, kind number, end) by start, then kind; a null text is empty.

    Repeated rows come out repeated, an empty table gives an empty result.
    """
    h, part, bits = fresh(docs, "text_hash", "text_part", "rule_bits")
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = candidates(docs, text_col, rules).toDF(h, part, bits)
    hash_, place = _place(docs, text_col)
    rows = docs.withColumns({h: hash_, part: place}).join(found, [h, part], "left")
    none = F.array().cast(_SPANS)
    parts = []
    for i, rule in enumerate(rules):
        may = F.col(bits).bitwiseAND(F.lit(1 << i)) != 0 if trigram_query(rule.pattern) else text.rlike(_needs(rule))
        parts.append(F.when(may, _matches(text, i, rule)).otherwise(none))
    return rows.withColumn(out, F.array_sort(F.concat(*parts))).drop(h, part, bits)


def listed(spans: Column, rules=RULES) -> Column:
    """kind:start:end of each span, comma-joined."""
    kinds = F.array(*(F.lit(r.kind) for r in rules))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """Counts by base kind, the digest of the base spans and all spans of each row.

    An empty table gives an empty result, repeated rows come out repeated.
    """
    rows = with_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))
    counts = [F.expr(f"cast(size(filter(spans, s -> s.kind = {i})) as long)").alias(f"n_{r.kind}") for i, r in enumerate(BASE)]
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    return rows.select(F.col("id").alias(id_col), *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text_col="text", mark="[secret]") -> DataFrame:
    """The rows with every span, or run of overlapping spans, replaced by ``mark``."""
    (spans,) = fresh(docs, "spans")
    rows = with_spans(docs, text_col, spans)

    def step(acc, s):
        gap = F.substring(F.col(text_col), acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], gap, F.lit(mark)).alias("out"))
                      ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    rest = lambda acc: F.concat(acc["out"], F.substring(F.col(text_col), acc["at"] + 1, F.length(F.col(text_col))))
    clean = F.when(F.size(spans) > 0, F.aggregate(spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, rest)).otherwise(F.col(text_col))
    return rows.withColumn(text_col, clean).select(*docs.columns)
