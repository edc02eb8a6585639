"""Corpus pipeline: documents -> filtered, deduplicated, decontaminated, mixed.

``STAGES`` lists (name, function) in order; every function takes
``(spark, docs, sf_dir)`` and returns a DataFrame. ``run`` writes each stage's
rows as Parquet to the shared folder and reads them back for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.llm import decontaminate, exact_dedup, jaccard_join, mixing, quality_fm
from mercato.llm.common import cut


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores below 0.5 go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_fm.keep(docs, quality_fm.train(docs, labels))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the smallest doc_id stays."""
    return jaccard_join.representatives(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: one row per copy taken, with the copy's number in mix_epoch."""
    return mixing.mixed_rows(docs)


STAGES = [
    ("quality_classifier", drop_low_quality),
    ("exact_dedup", drop_exact_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("source_mixing", mix_sources),
]

#: The classifier and the MinHash stages are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
