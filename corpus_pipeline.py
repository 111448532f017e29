"""From raw documents to packed sequences, a written table after each stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratelake import session
from ratelake.llm import mixing, packing, secrets, simhash, toxicity
from ratelake.llm.common import table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents scored as toxic. NULL and empty texts score low and stay; repeated rows fare alike."""
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the least id, then hash, of the group; NULL ids come last."""
    return simhash.kept_documents(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the secrets in it masked; a NULL text stays NULL, and no row goes."""
    return secrets.masked_documents(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; texts without words are never taken."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences: repeated documents are packed each for itself."""
    return packing.packed_documents(docs)


STAGES = [
    ("toxicity", clean),
    ("near_dedup", distinct),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: No SQL has XXH64, a forest or a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = session.staged(stage(spark, docs, sf_dir), session.run_dir(spark, f"pipeline-{name}"))
    return docs
