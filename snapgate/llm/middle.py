"""Fill-in-middle: each text is cut at two of its tokens and its parts put in another order.

One full match of a repeated group takes a whole text; the group's captures give every token's
end, so their number and both places to cut are looked up, not counted. The repetition is
possessive: the tokens are the leftmost ones and nothing is kept to go back to.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from snapgate.llm.common import fresh, map_chunks

# The tokens, the marks of the parts and the shares in percent.
TOKENS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TURNED_PCT, SPM_PCT = 90, 20
SEED = "1"


def draws(doc_id, seed=SEED) -> list[int]:
    """Four numbers below 2**32, fixed by the seed and the id; a null id is an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]


def cut(text: str, one: int, two: int) -> tuple[int, int, int]:
    """The number of tokens and where the prefix and the middle end."""
    ends = TOKENS.fullmatch(text).ends(1)
    a, b = sorted((one % (len(ends) + 1), two % (len(ends) + 1)))
    return len(ends), ends[a - 1] if a else 0, ends[b - 1] if b else 0


def turn(doc_id, text: str, seed=SEED, turned_pct=TURNED_PCT, spm_pct=SPM_PCT):
    """(n, form, prefix length, middle length, output) of a text."""
    h = draws(doc_id, seed)
    n, a, b = cut(text, h[0], h[1])
    if not text or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)) or h[2] % 100 >= turned_pct:
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < spm_pct:
        return n, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def fill_in_middle(docs: DataFrame, id_col="doc_id", text_col="text", carry=("doc_id",), seed=SEED,
                   turned_pct=TURNED_PCT, spm_pct=SPM_PCT) -> DataFrame:
    """The columns ``carry`` of each row, then n, form, prefix_chars, middle_chars and output.

    ``form`` is psm, spm or plain; a text that is empty, null or holds a mark stays plain, and
    plain texts have null lengths. The draws hang on the id alone, so rows with one id draw alike
    and repeated rows come out repeated. An added column whose name is carried already gets an
    underscore.
    """
    names = fresh(docs.select(*carry), "n", "form", "prefix_chars", "middle_chars", "output")
    inner = [f"c{i}" for i in range(len(carry))]
    rows = docs.select(*(F.col(c).alias(i) for c, i in zip(carry, inner)), F.col(id_col).cast("string").alias("id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    types = ["long", "string", "long", "long", "string"]
    schema = rows.select(*inner, *(F.lit(None).cast(t).alias(f"x{i}") for i, t in enumerate(types))).schema
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batch):
        made = [turn(i, t, seed, turned_pct, spm_pct) for i, t in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist())]
        added = [pa.array([m[k] for m in made], kind) for k, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays([batch.column(c) for c in inner] + added, schema.names)

    return map_chunks(rows, "text", schema, run).toDF(*carry, *names)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from: its parts in their own order."""
    part = F.split(output, "<[PSM]>", 4)
    psm = F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2)))
    spm = F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
