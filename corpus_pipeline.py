"""A training corpus from ``documents``: each stage works on all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.llm import bpe, decontam, pii, quality, simhash
from ledgerlake.llm.common import ship, staging
from ledgerlake.llm.queries import RANKS

Step = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_ranking(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the ranking puts below the cut."""
    ship(spark)
    return quality.kept(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    ship(spark)
    return simhash.one_of_each(docs, staging(spark, "pipeline-simhash"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that contain an item of the benchmark."""
    ship(spark)
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by its kind."""
    return pii.redacted(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with the digests of the ids and of what they decode to."""
    ship(spark)
    return bpe.token_report(bpe.encode(docs, RANKS), RANKS)


STAGES: list[tuple[str, Step]] = [
    ("quality_ranking", quality_ranking),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("byte_bpe", byte_bpe),
]

#: SQL can express neither the ranking nor the tokens; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again by the next stage."""
    stage = staging(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage.keep(step(spark, docs, sf_dir), name)
    return docs
