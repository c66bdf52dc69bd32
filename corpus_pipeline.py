"""Corpus pipeline: raw documents to encoded training text, one operator a stage.

Every stage takes all that the one before it kept.  All but the last return the columns of
``documents``; toxic documents, all but one of each group of near copies, and documents that hold
a benchmark passage go, and repeated passages are cut out of the texts that stay.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from movegrid.llm import decontaminate, encode, queries, simhash, substring, toxicity
from movegrid.llm.common import documents, materialize


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain, trained on ``labels``, does not judge toxic."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near copies, the one with the smallest id."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat within or across them."""
    return substring.cut_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes decoded from them."""
    return encode.digests(docs, public_tokenizers.path(queries.RANKS))


STAGES = [
    ("toxicity", toxicity_filter),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("benchmark_decontamination", decontamination),
    ("bpe_encoding", bpe_encoding),
]

#: The chain, the fingerprints and the tokenizer are beyond SQL; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages in order to ``documents``; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
