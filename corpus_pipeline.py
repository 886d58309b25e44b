"""A corpus from `documents`: language, near duplicates, benchmark passages, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. `run` writes
each result to the shared folder and reads it back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendengine.llm import decontaminate, langid, secret_scan, sentencepiece_fst, simhash
from trendengine.llm.common import remove_stored, stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled ones teach; texts without letters go."""
    return langid.drop_unidentified(spark, docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(spark, docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with passages of the benchmark."""
    return decontaminate.drop_contaminated(spark, docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced with a mark."""
    return secret_scan.redact_secrets(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their ids and how many they are."""
    return sentencepiece_fst.with_ids(spark, docs)


STAGES = [
    ("language", language),
    ("near duplicates", near_duplicates),
    ("benchmark passages", benchmark_passages),
    ("secrets", secrets),
    ("token ids", token_ids),
]

#: Hashes, trained models and tokenizers are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of all stages over `documents`. A stage's table goes once the next one is written."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        after = stored(spark, stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if k:
            remove_stored(spark, docs)
        docs = after
    return docs
