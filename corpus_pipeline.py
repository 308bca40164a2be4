"""A training corpus from ``documents``: each stage's rows are written and reread as the next one's.

toxicity       documents the grammar predicts toxic go
near_duplicates  one document of each SimHash group stays
secrets        secrets in the texts are replaced by a mark; n_chars follows
mixing         documents are sampled to the target weights
pieces         the kept texts as SentencePiece ids
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from snapgate.llm import mixing, pieces, secret_scan, simhash, toxicity
from snapgate.llm.common import fresh, keep, table
from snapgate.llm.queries import tokenizer


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The model is learned from all labelled documents of the corpus, then judges the given ones."""
    (score,) = fresh(docs, "score")
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.with_score(docs, model, out=score).where(F.col(score) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.sample(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, tokenizer())


STAGES = [("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("secrets", redact_secrets),
          ("mixing", mix), ("pieces", encode)]

#: Learned scores, graph components and tokenizers are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir))
    return docs
