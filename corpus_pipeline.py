"""A corpus from raw documents: toxicity, near-duplicates, secrets, source weights, tokens.

``STAGES`` are applied in order; each takes what the one before it kept.  All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foretell.llm import bpe, mixing, neardup, secret_scan, toxicity
from foretell.llm.common import load, stored


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the toxicity classifier rejects."""
    model = toxicity.trained(docs, load(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model).select(*_columns(docs))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8), the one with the smallest id."""
    return neardup.deduplicated(docs).select(*_columns(docs))


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with each secret replaced by a mark and its length counted anew."""
    out = secret_scan.redacted(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*_columns(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them: not at all, once or twice."""
    return mixing.copied(docs).select(*_columns(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, by the public byte-level vocabulary."""
    return bpe.encoded(docs)


STAGES = [
    ("toxicity", clean), ("minhash_near_dedup", distinct), ("secret_scan", redacted),
    ("source_mixing", mixed), ("byte_bpe", encoded),
]

#: no SQL: the classifier, the field and the tokenizer cannot be said in it; tests/llm compares with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again before the next."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
