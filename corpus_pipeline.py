"""A training corpus from documents: good ones, one of each near duplicate, without secrets, mixed and packed.

Each stage takes what the one before kept, as written Parquet.  Stages that filter or change documents
return the columns of documents; the last returns pieces in sequences.  Nulls, empty tables and
repeated rows are handled as the operators define it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from crmfunnel.llm import mixing, ngram_join, packing, quality, secret_scan
from crmfunnel.llm.common import stage, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it learns from the labelled ones among them that are not held out."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return ngram_join.keep_one(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secret_scan.redact(docs, length_col="n_chars")


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often, and of the last one of a source as many words, as the source's target takes."""
    return mixing.mixed(docs, length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of tokenised documents with their places in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each),
    ("secret scans", without_secrets),
    ("mixing sources", mixed_sources),
    ("best-fit packing", packed),
]

#: Classifier and tokenizer can't be written in SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
