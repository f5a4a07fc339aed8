"""The corpus pipeline: toxic documents go, repeated lines go, one document of each near-duplicate
group stays, documents with benchmark passages go, the rest becomes tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next stage's docs. All but the last return the columns of documents. A stage
works on all that the one before kept, and drops only what its operator finds.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gondola.llm import byte_pair, decontaminate, lines, simhash, toxicity
from gondola.llm.common import table
from gondola.llm.queries import RANKS
from gondola.session import remove, scratch_removed, shared_dir, store


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.acceptable(docs, table(spark, sf_dir, "labels"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.without_duplicate_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_per_component(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return byte_pair.token_report(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_stage),
    ("near dedup", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("tokens", token_stage),
]

#: The trained toxicity stage has no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is stored in the shared folder in between.

    What a stage wrote on the way goes when its result stands, and a stage's input with it; only
    the last result stays. NULL and empty texts pass every stage but near-duplicate removal,
    where they are copies of each other; rows that repeat a doc_id are judged each by its text;
    no documents give no rows, and columns of any name pass unchanged.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}-{number}"
        with scratch_removed(spark):
            store(stage(spark, docs, sf_dir), path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
