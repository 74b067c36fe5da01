"""The corpus pipeline: quality rules, near-duplicates, personal data, packing.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last keep the
columns of documents, and each works on all that its predecessor kept.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import ngram_join, packing, pii, quality_rules
from eventloom.llm.common import free_names, stored, table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learn a decision list from the labels of the given documents and drop what it rejects."""
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    stats, = free_names(docs, "stats_")
    judged = quality_rules.with_statistics(docs, stats)
    return judged.where(quality_rules.verdict(rules, stats)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by a Jaccard similarity of 0.8 or more."""
    return ngram_join.deduplicated(docs, n=5, threshold=0.8)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind; texts without any stay as they are."""
    return pii.redact(docs, pii.learn(docs), size="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048."""
    return packing.pack(packing.pieces(docs, TOKENIZER, capacity=2048, end_id=0), capacity=2048)


STAGES = [("quality_rules", quality), ("ngram_join", near_duplicates), ("pii", personal_data), ("packing", packed)]

ORACLE_SQL = None  # learned rules, learned redactions and packing have no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
