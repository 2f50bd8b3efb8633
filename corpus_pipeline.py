"""A corpus from raw documents to token segments, each stage stored before the next begins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillbook.llm import decontamination, language, mixing, near_dedup, token_output
from tillbook.llm.common import importable, read_table, stored
from tillbook.llm.queries import tokenizer_path


@importable
def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose language cannot be told."""
    return language.drop_unidentified(docs, language.fit_fold(docs))


@importable
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return near_dedup.drop_near_duplicates(docs)


@importable
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents contaminated by benchmark passages."""
    return decontamination.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@importable
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents by the weights of their sources, some more than once, some in part."""
    return mixing.mixed(docs)


@importable
def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write token segments; per document what the files hold."""
    return token_output.token_output(docs, tokenizer_path(), special_as_text=False)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_stage),
    ("near_dedup", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_output", token_stage),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
