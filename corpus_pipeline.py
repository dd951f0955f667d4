"""The corpus pipeline: quality, language, exact and near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept. All
but the last return the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestack.llm import exact_dedup, language_id, near_copies, packing, quality
from lodestack.llm.work import in_files, materialise, without


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose quality score is below one half."""
    return quality.keep_good(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language_identification(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, and those of which no language holds two fifths."""
    return language_id.keep_known(spark, docs)


def exact_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keeps the row with the largest doc_id."""
    docs = in_files(docs)
    return without(docs, exact_dedup.dedup(spark, docs).filter("not kept"))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies (five-word shingles, Jaccard similarity of at least 0.8), keeps the row with the smallest doc_id."""
    docs = in_files(docs)
    return without(docs, near_copies.near_copies(spark, docs).filter("not stays"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 1024 tokens."""
    return packing.pack(spark, docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("language_identification", language_identification),
    ("exact_deduplication", exact_deduplication),
    ("near_deduplication", near_deduplication),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither classifier nor language model; tests/llm holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
