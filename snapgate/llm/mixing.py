"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell of source, language and topic. The cell table has at most the product
of the listed categories, each with one more for values that are not listed, whatever the input;
it is raked on the driver to the target shares of each margin. No cell may give more tokens than
it has, so the ratio of raked to present tokens is a probability, with which each document of
the cell is sampled by a hash. Where the cells hold too little for the wanted total, the total is
lowered until the shares fit; what is reached stands beside the probabilities.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from snapgate.llm.common import fresh

#: Share of all tokens that the sample holds, where the margins allow it; else the largest that they allow.
FRACTION = 0.5
ROUNDS, TOLERANCE = 500, 1e-9
#: Error of a share up to which the margins count as met, and halvings of the total's interval.
FITS, HALVINGS = 1e-4, 12
OTHER = "(other)"

# The target shares of the registered query and the pipeline, far from the natural ones.
TARGETS = {
    "source": {f"src{i}": 3.0 if i % 2 else 1.0 for i in range(20)},
    "lang": {"en": 0.30, "de": 0.23, "fr": 0.25, "es": 0.22},
    "topic": {"prose": 0.888, "note": 0.01, "contact": 0.04, "table": 0.012, "licence": 0.05},
}


def topic_of(text: Column) -> Column:
    """A topic by the first rule that fits: licence notes, tables, contact data, short notes, prose."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(text.contains(" License"), "licence").when(text.contains(" | "), "table")
            .when(text.contains("@") | text.contains("://"), "contact").when(F.length(text) < 400, "note").otherwise("prose"))


def tokens_of(text: Column) -> Column:
    """Words of a text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("double")


def rake(mass: np.ndarray, shares: list[np.ndarray], total: float, rounds=ROUNDS, tolerance=TOLERANCE):
    """Cell masses with the wanted margins, none above ``mass``, and the largest error of a share.

    shares: one array per axis. A category without mass gives its share to the others of its axis.
    """
    out = mass * (total / mass.sum()) if mass.sum() else mass.copy()
    if not mass.sum():
        return out, 0.0
    wanted = []
    for axis, share in enumerate(shares):
        present = mass.sum(tuple(k for k in range(mass.ndim) if k != axis)) > 0
        share = np.where(present, share, 0.0)
        wanted.append(total * (share if share.sum() else present.astype(float)) / (share.sum() or present.sum()))
    error = np.inf
    for _ in range(rounds):
        for axis, want in enumerate(wanted):
            rest = tuple(k for k in range(mass.ndim) if k != axis)
            have = out.sum(rest)
            factor = np.divide(want, have, out=np.zeros_like(want), where=have > 0)
            out = out * factor.reshape([-1 if k == axis else 1 for k in range(mass.ndim)])
        out = np.minimum(out, mass)
        error = max(float(np.abs(out.sum(tuple(k for k in range(mass.ndim) if k != axis)) - want).max()) / total for axis, want in enumerate(wanted))
        if error < tolerance:
            break
    return out, error


def rake_down(mass: np.ndarray, shares: list[np.ndarray], total: float):
    """:func:`rake` at ``total`` or, where that does not fit, at the largest total found to fit: (cells, total, error).

    Cells that fit a total fit every smaller one when scaled down, so halving finds the largest.
    Shares that the categories present cannot meet at any total, as when two only come together,
    keep an error; then the largest total counts whose error is no greater than a tiny total's.
    """
    out, error = rake(mass, shares, total)
    if error <= FITS:
        return out, total, error
    low, high = total * 0.5 ** HALVINGS, total
    best = low, *rake(mass, shares, low)
    bound = max(FITS, best[2] + FITS)
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        out, error = rake(mass, shares, middle)
        if error <= bound:
            low, best = middle, (middle, out, error)
        else:
            high = middle
    return best[1], best[0], best[2]


def _axis(name: str, targets: dict[str, float], text_col: str) -> Column:
    """The category, or OTHER for a null or a value that has no target; the topic is that of the text."""
    value = topic_of(F.col(text_col)) if name == "topic" else F.col(name)
    return F.when(value.isin(*targets), value).otherwise(F.lit(OTHER))


def probabilities(cells: DataFrame, targets: dict[str, dict[str, float]], fraction=FRACTION) -> tuple[list[tuple], float, float]:
    """(category of each margin, ..., probability) of each cell with tokens, the share of all tokens that
    the sample is to hold, and the largest error of a target share in it.

    Values without a target keep their present share of the tokens; the listed ones share the rest.
    """
    names = list(targets)
    lists = {n: [*targets[n], OTHER] for n in names}
    at = {n: {v: i for i, v in enumerate(lists[n])} for n in names}
    mass = np.zeros([len(lists[n]) for n in names])
    for r in cells.collect():
        mass[tuple(at[n][r[n]] for n in names)] = r["tokens"] or 0.0
    if not mass.sum():
        return [], float(fraction), 0.0
    shares = []
    for k, n in enumerate(names):
        share = np.array([*targets[n].values(), 0.0])
        other = mass.take(-1, axis=k).sum() / mass.sum()
        shares.append(np.append(share[:-1] / share.sum() * (1 - other), other))
    raked, total, error = rake_down(mass, shares, fraction * mass.sum())
    return ([(*(lists[n][i] for n, i in zip(names, cell, strict=True)), float(raked[cell] / mass[cell]))
             for cell in zip(*np.nonzero(mass), strict=True)], float(total / mass.sum()), float(error))


def mix_sources(docs: DataFrame, targets=None, id_col="doc_id", text_col="text", fraction=FRACTION, seed=17) -> DataFrame:
    """(id, source, lang, topic, n_tokens, probability, sampled, fraction, share_error) of each row.

    fraction: the share of all tokens that the sample is to hold, below the wanted one where the
    targets do not fit it; share_error: the largest error of a target share, the same on all rows.
    The topic is made of the text, whatever columns ``docs`` has; the other axes are columns.
    A null category or one without a target counts as ``(other)``. A document without tokens
    takes its cell's probability, or that fraction in a cell without tokens. Rows with the same id
    and text are sampled alike.
    """
    targets = targets or TARGETS
    names = list(targets)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       *(_axis(n, targets[n], text_col).alias(n) for n in names))
    rows = rows.withColumn("n_tokens", tokens_of(F.col("text")))
    found, fraction, error = probabilities(rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")), targets, fraction)
    schema = ", ".join(f"{n} string" for n in names) + ", probability double"
    table = F.broadcast(docs.sparkSession.createDataFrame(found, schema))
    draw = F.expr(f"shiftrightunsigned(xxhash64(id, text, {seed}), 11) / 9007199254740992D")
    return (rows.join(table, names, "left").withColumn("probability", F.coalesce("probability", F.lit(fraction)))
            .select(F.col("id").alias(id_col), *names, F.col("n_tokens").cast("long").alias("n_tokens"), "probability",
                    (draw < F.col("probability")).alias("sampled"), F.lit(fraction).alias("fraction"), F.lit(error).alias("share_error")))


def sample(docs: DataFrame, targets=None, id_col="doc_id", text_col="text", fraction=FRACTION, seed=17) -> DataFrame:
    """The sampled rows with the columns of ``docs``; a warning tells a lowered total or shares that are missed.

    Categories are those of :func:`mix_sources`.
    """
    names = list(targets or TARGETS)
    inner = fresh(docs, *(f"mix_{n}" for n in names), "mix_probability")
    targets = targets or TARGETS
    marked = docs.withColumns({c: _axis(n, targets[n], text_col) for n, c in zip(names, inner, strict=False)})
    cells = marked.groupBy(*inner[:-1]).agg(F.sum(tokens_of(F.col(text_col))).alias("tokens"))
    found, reached, error = probabilities(cells.select(*(F.col(c).alias(n) for n, c in zip(names, inner, strict=False)), "tokens"), targets, fraction)
    if error > FITS or reached < fraction:
        warnings.warn(f"mixing: the sample holds {reached:.4f} of the tokens, wanted {fraction}; largest error of a share {error:.1e}", stacklevel=2)
    schema = ", ".join(f"{c} string" for c in inner[:-1]) + f", {inner[-1]} double"
    table = F.broadcast(docs.sparkSession.createDataFrame(found, schema))
    draw = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")), F.lit(seed)), 11) / F.lit(9007199254740992.0)
    return (marked.join(table, inner[:-1], "left").where(draw < F.coalesce(inner[-1], F.lit(reached))).select(*docs.columns))
