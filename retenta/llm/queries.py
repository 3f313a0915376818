"""The registered queries of this folder: one per operator, and the pipeline when its file is there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retenta.llm import (align, ann, arrow_store, bpe, hard_negatives, line_dedup, mixing, quality, sharding, simhash, suffix_dedup, topk,
                         toxicity)
from retenta.llm.frames import documents


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digest(documents(spark, sf_dir))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(documents(spark, sf_dir))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(_table(spark, sf_dir, "embeddings"))


def op8_arrow_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arrow_store.written_and_read(documents(spark, sf_dir))


def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digest(documents(spark, sf_dir))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removal_report(documents(spark, sf_dir))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mined(_table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment_digest(documents(spark, sf_dir))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.plan(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_array_dedup, op2_quality_classifier, op3_toxicity, op4_simhash_near_dedup, op5_exact_topk, op6_source_mixing,
        op7_nearest_neighbours, op8_arrow_token_output, op9_bpe_round_trip, op10_line_dedup, op11_hard_negatives,
        op12_token_alignment, op13_sharding)}

SQL: dict[str, str] = {
    "op5_exact_topk": topk.SQL, "op6_source_mixing": mixing.SQL, "op7_nearest_neighbours": ann.SQL,
    "op11_hard_negatives": hard_negatives.SQL}
