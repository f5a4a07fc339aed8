"""The registered queries of this subpackage, each over whole tables, and the SQL for them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gondola.llm import (
    alignment, byte_pair, decontaminate, filters, html, language, lines, metric_search, quality, secrets, simhash, toxicity,
    vector_dedup,
)
from gondola.llm.common import table

RANKS = "byte_bpe_50k.tiktoken"
BYTES, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.report(table(spark, sf_dir, "pages"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_report(table(spark, sf_dir, "documents"))


def op6_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_search.report(table(spark, sf_dir, "embeddings"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return byte_pair.token_report(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op11_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.report(docs, public_tokenizers.path(BYTES), public_tokenizers.path(PIECES))


def op13_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_html, op2_toxicity, op3_simhash, op4_decontaminate, op5_lines, op6_search, op7_byte_bpe, op8_quality,
             op9_language, op10_secrets, op11_vector_dedup, op12_alignment, op13_filters)
    return {f.__name__: f for f in every}


def oracle() -> dict[str, str]:
    from gondola.llm.oracle import SQL

    return dict(SQL)
