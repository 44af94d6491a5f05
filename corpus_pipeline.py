"""Cleaning pipeline of the documents table: quality rules, near-duplicates,
benchmark passages, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which
:func:`run` writes as Parquet and reads again for the next stage, so every
stage works on all that its predecessor kept.  All but the last return the
columns of ``documents``; the last adds ``n_tokens`` and ``token_ids``.

Null, empty and word-less texts go at the first stage, which asks for 50 words;
given to a later stage they are kept (near_dedup: one of all word-less ones) and
have no tokens.  Rows that repeat an id are rows of their own, rows without an
id stay unless a copy with one does.  Empty tables pass through every stage,
and other columns keep their names and values.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from userflow.llm import bpe, decontam, quality, secret_ledger, simhash
from userflow.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the risk-controlled cutoffs, the
    labels of the corpus being the holdout."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that with the smallest id."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, the secrets in them replaced."""
    return secret_ledger.mask_secrets(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their token ids."""
    return bpe.add_ids(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mask_secrets", mask_secrets),
    ("token_ids", token_ids),
]

#: Fingerprints, the window search and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
