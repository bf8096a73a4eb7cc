"""From raw documents to token ids: language, quality, near duplicates, benchmark passages, encoding.

Every stage but the last returns documents as they are, fewer of them; its result is written and read again before the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from wardenlake.functions.storage import materialize
from wardenlake.llm import byte_bpe, language_spans, ngram_jaccard, ordinal_quality, passage_alignment
from wardenlake.llm.batches import bound_batches, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language that has at least half of their letters."""
    bound_batches(spark)
    return language_spans.with_language(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected rating is fine and not toxic."""
    return ordinal_quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group with 5-gram similarity of 0.8 or more."""
    bound_batches(spark)
    return ngram_jaccard.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have less than half of every test item."""
    return passage_alignment.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to."""
    bound_batches(spark)
    return byte_bpe.round_trip_digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

ORACLE_SQL = None  # models and searches aren't SQL; tests/llm/test_pipeline.py holds every stage against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
