"""Queries of the training-data operators: thin wrappers that fix production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestack.llm import exact_dedup, html_text, language_id, media_webp, packing, quality, sentencepiece_codec, sharding, simhash, token_store


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(spark, documents(spark, sf_dir))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, documents(spark, sf_dir))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(spark, documents(spark, sf_dir)).drop("file", "row")


def op4_media_webp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_webp.media_columns(spark, documents(spark, sf_dir))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.round_trip(spark, documents(spark, sf_dir))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(spark, documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.op8(spark, documents(spark, sf_dir))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(spark, documents(spark, sf_dir))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(spark, documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_media_webp": op4_media_webp,
    "op5_html_text": op5_html_text,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_token_store": op8_token_store,
    "op9_sharding": op9_sharding,
    "op10_simhash": op10_simhash,
}
ORACLES: dict[str, str] = {"op3_exact_dedup": exact_dedup.SQL}
