"""One query per operator, over the whole intended table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import oracle
from shelfwise.llm.bpe import bpe_digests
from shelfwise.llm.bwt import remove_repeated_bytes
from shelfwise.llm.common import Stages
from shelfwise.llm.contamination import contamination_report
from shelfwise.llm.conversations import repair_report
from shelfwise.llm.covertree import near_vectors
from shelfwise.llm.doubling import remove_repeated_words
from shelfwise.llm.html import extract_pages
from shelfwise.llm.langid import identify
from shelfwise.llm.lines import line_report
from shelfwise.llm.merkle import manifest_report
from shelfwise.llm.minhash import near_duplicates
from shelfwise.llm.mixing import mix
from shelfwise.llm.quality import quality

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(table(spark, sf_dir, "documents"), Stages(spark), window=35)


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(
        table(spark, sf_dir, "documents"), Stages(spark), words=3, numerator=85, denominator=100
    )


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"), Stages(spark), window=200)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(table(spark, sf_dir, "documents"), Stages(spark))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), Stages(spark), cosine=0.9)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), Stages(spark))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), Stages(spark))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(table(spark, sf_dir, "conversations"), Stages(spark))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Stages(spark)
    )


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_report(table(spark, sf_dir, "documents"), Stages(spark))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    built = (
        op1_substring_dedup,
        op3_suffix_array_dedup,
        op2_minhash_near_dedup, op4_language_id, op5_line_dedup,
        op6_embedding_near_dedup, op7_quality_rules, op8_html_extraction, op9_mixing,
        op10_byte_bpe, op11_conversation_repair, op12_decontamination, op13_merkle_manifest,
    )
    return {f.__name__: f for f in built}


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
