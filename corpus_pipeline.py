"""From raw documents to token ids: quality rules, language, near copies, benchmark leaks, encoding."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pageloom.llm import bpe, decontaminate, jaccard, langid, quality
from pageloom.llm.base import table, written


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break a quality rule go."""
    return quality.keep_good(docs)


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no language that the labelled ones teach go."""
    return langid.keep_known(docs, langid.train(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays."""
    return jaccard.keep_one(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and the text they decode to."""
    return bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", by_quality), ("language ID", by_language), ("n-gram Jaccard join", without_copies),
    ("benchmark decontamination", without_leaks), ("BPE encoding", as_tokens),
]

# Language models, edit distances and merges cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage keeps is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
