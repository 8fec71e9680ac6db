"""The corpus pipeline: documents in, a cleaned, deduplicated and mixed corpus out."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from doseline.llm import decontamination, exact_dedup, language, mixture, simhash
from doseline.llm.common import keep, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter, or in no language with a share of half or more."""
    ship(spark)
    return language.drop_unknown_languages(docs, public_tokenizers.path("piece_bpe_32k.model"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of equal ones."""
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group whose fingerprints are linked."""
    ship(spark)
    return simhash.drop_near_copies(docs)


def benchmark_overlaps(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that overlap a benchmark item."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out documents so that sources come near their target weights."""
    return mixture.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("exact_dedup", exact_copies),
    ("simhash", near_copies),
    ("decontamination", benchmark_overlaps),
    ("mixture", source_mix),
]

# The first stage is a trained model and the third a closure over fingerprints: not for SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to `documents`; each stage's rows are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


query = run
