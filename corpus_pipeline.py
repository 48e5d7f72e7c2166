"""The training-data pipeline: identify language, keep good text, keep one of each group of near copies, mix sources, pack."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import jaccard, language, mixing, packing, quality
from strandline.llm.shared import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letter in the text, or no language with a posterior of one half."""
    return language.keep_identified(docs, *language.train(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fail the base rules or lie below the log-ratio threshold that trusted documents set."""
    return quality.keep_good(docs, *quality.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of linked documents the one with the smallest id, once if its row repeats; documents without words or id stay."""
    return jaccard.keep_one(docs, words=5, percent=80)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequence and offset."""
    return packing.pack(docs)


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", source_mixing),
    ("best-fit packing", best_fit_packing),
]

#: SQL cannot express the learned language model. Tests hold the Jaccard stage against brute force and check what the other stages keep; their operators are tested against brute force on their own.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
