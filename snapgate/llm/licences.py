"""Licence scans by sentence rules.

Sentences are normalised and looked up among known licence sentences; what is found is a sequence
of sentence identifiers in the order of the text, in which ordered licence rules are matched: all
identifiers of a rule, in order, with few other sentences between. Sentences are read twice, cut at
line ends and with line ends as spaces, so that wrapped licence texts are found as well.
"""

from __future__ import annotations

import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from snapgate.llm.common import map_chunks

#: Unknown sentences that may lie between two of a rule.
MAX_GAP = 3

# Known sentences by identifier, each as texts are cut, so without a stop inside.
SENTENCES = {
    "apache2.notice": "Licensed under the Apache License, Version 2.0",
    "apache2.header.1": 'Licensed under the Apache License, Version 2.0 (the "License")',
    "apache2.header.2": "you may not use this file except in compliance with the License",
    "apache2.header.3": "You may obtain a copy of the License at",
    "apache2.header.4": ("Unless required by applicable law or agreed to in writing, software distributed under the License is "
                         'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied'),
    "mit.notice": "Released under the MIT License",
    "mit.title": "MIT License",
    "mit.grant": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
                  "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
                  "to permit persons to whom the Software is furnished to do so, subject to the following conditions"),
    "mit.copy": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
    "mit.as_is": ('THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
                  "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"),
    "mit.liability": ("IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
                      "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
                      "OTHER DEALINGS IN THE SOFTWARE"),
    "bsd.grant": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                  "following conditions are met"),
    "bsd.source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
    "bsd.binary": ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
                   "disclaimer in the documentation and/or other materials provided with the distribution"),
    "bsd.names": ("Neither the name of {name} nor the names of its contributors may be used to endorse or promote products "
                  "derived from this software without specific prior written permission"),
    "gpl3.notice": "This work is licensed under the GNU General Public License, version 3",
    "gpl.free.1": "This program is free software",
    "gpl.free.2": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
                   "Software Foundation, either version 3 of the License, or (at your option) any later version"),
    "gpl.hope": ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY"),
    "ccbync4.notice": "Licensed under CC BY-NC 4.0",
    "ccby4.notice": "Licensed under CC BY 4.0",
    "ccbysa4.notice": "Licensed under CC BY-SA 4.0",
    "mit.notice.2": "Licensed under the MIT License",
    "mit.notice.3": "This project is licensed under the MIT License",
    "apache2.notice.2": "Licensed under the Apache License 2.0",
    "gpl2.notice": "This work is licensed under the GNU General Public License, version 2",
    "gpl2.free": ("you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                  "published by the Free Software Foundation"),
    "gpl2.version": "either version 2 of the License, or (at your option) any later version",
    "lgpl3.free": ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                   "published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                   "later version"),
    "lgpl21.free": ("you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
                    "published by the Free Software Foundation"),
    "lgpl21.version": "either version 2.1 of the License, or (at your option) any later version",
    "agpl3.free": ("you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
                   "published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
                   "later version"),
    "mpl2.notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v",
    "isc.grant": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                  "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
                  "copies"),
    "unlicense.free": "This is free and unencumbered software released into the public domain",
    "cc0.notice": "Licensed under CC0 1.0",
    "reserved": "All rights reserved",
    "spdx.tag": "SPDX-License-Identifier",
}
# Licences as ordered sentence identifiers.
LICENCES = (
    ("Apache-2.0", ("apache2.notice",)),
    ("Apache-2.0", ("apache2.header.1", "apache2.header.2")),
    ("Apache-2.0", ("apache2.header.3", "apache2.header.4")),
    ("MIT", ("mit.notice",)),
    ("MIT", ("mit.grant", "mit.copy", "mit.as_is")),
    ("BSD-2-Clause", ("bsd.grant", "bsd.source", "bsd.binary")),
    ("BSD-3-Clause", ("bsd.grant", "bsd.source", "bsd.binary", "bsd.names")),
    ("GPL-3.0", ("gpl3.notice",)),
    ("GPL-3.0-or-later", ("gpl.free.1", "gpl.free.2", "gpl.hope")),
    ("CC-BY-NC-4.0", ("ccbync4.notice",)),
    ("CC-BY-4.0", ("ccby4.notice",)),
    ("CC-BY-SA-4.0", ("ccbysa4.notice",)),
    ("MIT", ("mit.notice.2",)),
    ("MIT", ("mit.notice.3",)),
    ("Apache-2.0", ("apache2.notice.2",)),
    ("GPL-2.0", ("gpl2.notice",)),
    ("GPL-2.0-or-later", ("gpl.free.1", "gpl2.free", "gpl2.version")),
    ("LGPL-3.0-or-later", ("lgpl3.free",)),
    ("LGPL-2.1-or-later", ("lgpl21.free", "lgpl21.version")),
    ("AGPL-3.0-or-later", ("agpl3.free",)),
    ("MPL-2.0", ("mpl2.notice",)),
    ("ISC", ("isc.grant",)),
    ("Unlicense", ("unlicense.free",)),
    ("CC0-1.0", ("cc0.notice",)),
    ("Proprietary", ("reserved",)),
)

_END = re.compile(r"[.!?;:](?=\s|$)")
_END_OR_LINE = re.compile(r"[.!?;:](?=\s|$)|\n")
_PARAGRAPH = re.compile(r"\n\s*\n")
_MARKS = re.compile(r"[\W_]+")


def normal(sentence: str) -> str:
    """Lower case, every run of other characters than letters and digits one space."""
    return _MARKS.sub(" ", sentence).strip().lower()


assert not any(_END.search(text) for text in SENTENCES.values())
KNOWN = {normal(text): name for name, text in SENTENCES.items() if "{name}" not in text}
#: Sentences with a slot: the normal text before and behind it, and the words it may have.
SLOTS = [(*(normal(part) for part in text.split("{name}")), name) for name, text in SENTENCES.items() if "{name}" in text]
SLOT_WORDS = 12
#: Words of which every known sentence holds one, so that most texts are passed over at once.
HINTS = re.compile("licen|permission|redistribut|warrant|copyright|software|all rights", re.IGNORECASE)
assert all(HINTS.search(text) for text in SENTENCES.values())
#: Characters of the longest known normal sentence.
LONGEST = max(max(map(len, KNOWN)), max(len(a) + len(b) for a, b, _ in SLOTS) + 20 * SLOT_WORDS)


def known_sentence(words: str) -> str | None:
    """The identifier of a normal sentence."""
    if words in KNOWN:
        return KNOWN[words]
    for before, behind, name in SLOTS:
        if words.startswith(before + " ") and words.endswith(" " + behind) and (
                0 < len(words[len(before):len(words) - len(behind)].split()) <= SLOT_WORDS):
            return name
    return None


def _known_tail(piece: str) -> tuple[str | None, int]:
    """The longest known sentence that begins at a line of the piece but the first and ends with it, and its place."""
    found, words, end = (None, 0), "", len(piece)
    while len(words) <= LONGEST and (at := piece.rfind("\n", 0, end)) >= 0:
        line = normal(piece[at + 1:end])
        if line:
            words = f"{line} {words}" if words else line
            name = known_sentence(words)
            if name:
                found = name, at + 1 + len(piece[at + 1:end]) - len(piece[at + 1:end].lstrip())
        end = at
    return found


def sentences(text: str) -> list[tuple[int, int, str | None]]:
    """(start, end, identifier or None) of the sentences, in order; spans in code points.

    A sentence across line ends stands in place of the lines it covers if it is known.
    """
    lines, wrapped = [], []
    for ends, out in ((_END_OR_LINE, lines), (re.compile(_END.pattern + "|" + _PARAGRAPH.pattern), wrapped)):
        at = 0
        for m in [*ends.finditer(text), None]:
            end = m.start() if m else len(text)
            piece = text[at:end]
            if piece.strip():
                start = at + len(piece) - len(piece.lstrip())
                name = known_sentence(normal(piece)) if HINTS.search(piece) else None
                if name is None and out is wrapped:
                    # a heading without a stop may stand on the lines before
                    name, place = _known_tail(piece)
                    start = at + place if name else start
                out.append((start, at + len(piece.rstrip()), name))
            at = m.end() if m else end
    known = [s for s in wrapped if s[2]]
    begins = [s[0] for s in known]

    def covered(at: int) -> bool:
        k = bisect_right(begins, at) - 1
        return k >= 0 and at < known[k][1]

    return sorted([s for s in lines if not covered(s[0])] + known)


# Public names of licences beside those the rules give.
SPDX = {normal(name): name for name in (*(licence for licence, _ in LICENCES if licence != "Proprietary"), "GPL-2.0-only", "GPL-3.0-only",
                                        "LGPL-2.1-only", "LGPL-3.0-only", "AGPL-3.0-only", "0BSD", "Zlib", "BSL-1.0", "EPL-2.0")}
_NOTICE = re.compile(r"copyright|©|\(c\)", re.IGNORECASE)
_OPERATOR = re.compile(r" (?:or|and) ")


def _tagged(text: str, found, i: int) -> list[str]:
    """The licences named in the sentence behind an SPDX tag."""
    if i + 1 >= len(found) or text[found[i][1]:found[i + 1][0]].strip(" \t:"):
        return []
    names = normal(text[found[i + 1][0]:found[i + 1][1]])
    parts = [SPDX.get(p) for p in _OPERATOR.split(names)]
    if None in parts:      # what follows the name on its line, such as the end of a comment, is no part of it
        parts = [SPDX.get(" ".join(names.split()[:k])) for k in range(len(names.split()), 0, -1)]
        parts = [p for p in parts if p][:1]
    return parts


def scan(text: str):
    """(identifiers, licences, spans): known sentences, and matched rules with the text they cover.

    Reserved rights of a copyright notice give way to a licence that begins within ``MAX_GAP``
    sentences behind them.
    """
    if not HINTS.search(text):
        return [], [], []
    found = sentences(text)
    names = [n for _, _, n in found]
    at = {}
    for i, n in enumerate(names):
        at.setdefault(n, []).append(i)
    matched, placed = [], []
    for licence, rule in LICENCES:
        for first in at.get(rule[0], ()):
            last = first
            for name in rule[1:]:
                places = at.get(name, ())
                k = bisect_right(places, last)
                last = places[k] if k < len(places) and places[k] <= last + 1 + MAX_GAP else None
                if last is None:
                    break
            if last is not None:
                matched.append((found[first][0], found[last][1], licence, len(rule)))
                placed.append((first, licence))
    for i in at.get("spdx.tag", ()):
        for licence in _tagged(text, found, i):
            matched.append((found[i][0], found[i + 1][1], licence, 2))
            placed.append((i, licence))
    granted = sorted(first for first, licence in placed if licence != "Proprietary")

    def granted_behind(first: int) -> bool:
        k = bisect_right(granted, first)
        notice = text[found[max(0, first - MAX_GAP)][0]:found[first][0]]
        return k < len(granted) and granted[k] <= first + 1 + MAX_GAP and _NOTICE.search(notice) is not None

    yields = {found[first][0] for first, licence in placed if licence == "Proprietary" and granted_behind(first)}
    matched = [m for m in matched if m[2] != "Proprietary" or m[0] not in yields]
    # a rule inside a longer match of another gives way to it
    reach: dict[int, tuple[list[int], list[int]]] = {}
    for start, end, _, size in sorted(matched):
        starts, ends = reach.setdefault(size, ([], []))
        starts.append(start)
        ends.append(max(end, ends[-1]) if ends else end)

    def inside(m) -> bool:
        for size, (starts, ends) in reach.items():
            k = bisect_right(starts, m[0]) - 1
            if size > m[3] and k >= 0 and m[1] <= ends[k]:
                return True
        return False

    best = sorted({m[:3] for m in matched if not inside(m)})
    return [n for n in names if n], sorted({m[2] for m in best}), best


def licence_scan(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, n_sentences, sentences, licences, spans) of each row.

    sentences: known identifiers in order; licences: matched licences, sorted; spans:
    licence:start:end by start; all comma-joined and empty where nothing is found, as for a null
    or empty text. Repeated rows come out repeated.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    names = ["n_sentences", "sentences", "licences", "spans"]
    schema = rows.select("id", F.lit(0).cast("long").alias(names[0]), *(F.lit("").alias(n) for n in names[1:])).schema

    def run(batch):
        got = [scan(t or "") for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([
            batch.column("id"), pa.array([len(g[0]) for g in got], pa.int64()), pa.array([",".join(g[0]) for g in got], pa.string()),
            pa.array([",".join(g[1]) for g in got], pa.string()),
            pa.array([",".join(f"{n}:{a}:{b}" for a, b, n in g[2]) for g in got], pa.string())], ["id", *names])

    return map_chunks(rows, "text", schema, run).withColumnRenamed("id", id_col)
