"""The corpus pipeline: documents in, packed sequences out."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import langid, minhash, mixing, packing, secrets
from tidemark.llm.common import prepare, stage

#: The tokenizer that documents are packed by.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those without a letter go."""
    return langid.keep_identified(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return minhash.drop_near_duplicates(docs)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts give way to a mark of their kind."""
    return secrets.redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.take_mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Learned filters, near-duplicate groups and token ids are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each one's rows written and read again by the next."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
