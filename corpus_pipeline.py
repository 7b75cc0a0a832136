"""A corpus pipeline over the documents table: filter, deduplicate, redact, mix, pack.

Each stage works on what the one before it kept, written as Parquet and read
again. All but the last return the columns of documents; the last returns the
packed pieces of packing.pack().
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import mixing, ngram_join, packing, quality, secrets
from vigil.llm.common import stored, table


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality discriminant scores 0.5 or more."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return ngram_join.one_of_each(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret."""
    return secrets.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's rate says."""
    return mixing.emitted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of at most 1,024 tokens and 32 documents."""
    return packing.pack(docs, packing.Capacity(documents=32, weights=(1.0, 0.1, 1e-3)))


STAGES = [
    ("quality classifier", quality_filter),
    ("n-gram Jaccard join", near_duplicate_filter),
    ("secret scans", secret_redaction),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", packing_stage),
]

#: None: neither the discriminant's scores nor a tokenizer's ids can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = stored(docs) if k < len(STAGES) - 1 else docs
    return docs
