"""A training corpus from raw documents: five stages, each one operator over all its predecessor kept.

Each stage function takes ``(spark, docs, sf_dir)``; all but the last return the columns of
the documents table.  ``run`` applies them to the documents of a data set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyho.llm import bpe, lang, minhash, mixing, quality_rules
from tallyho.llm.common import landed, prepare, read
from tallyho.llm.queries import vocabulary


def passing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    prepare(spark)
    return quality_rules.keep_passing(docs)


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    prepare(spark)
    return lang.keep_identified(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    prepare(spark)
    return minhash.dedup(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    prepare(spark)
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids: doc_id, n_tokens, ids."""
    prepare(spark)
    return bpe.encode_documents(docs, vocabulary())


STAGES = [("quality rules", passing), ("language ID", identified), ("near-dedup", distinct), ("mixing", mixed), ("BPE", encoded)]

# Language ID and BPE are beyond SQL; tests/llm compares the pipeline with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents, each one's result written once and reread by the next."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = landed(docs, f"stage{k}")
    return docs
