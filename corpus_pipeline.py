"""Corpus pipeline: quality classifier, near-duplicate join, decontamination, personal data,
mixing. Every stage takes the documents that its predecessor kept and returns documents
with the same columns; the last one returns them in training order with the words to take.

``run`` writes every stage as Parquet in the folder of ``spark.checkpoint.dir`` and reads it
back, so a lost executor repeats at most a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.llm import decontaminate, jaccard_join, mixing, pii, quality
from tidewrack.session import stage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fits the ordinal classifier on the labelled documents and drops what it rejects."""
    return quality.select_quality(docs, quality.fit_tables(docs, spark, sf_dir))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates (five words, 0.8)."""
    return jaccard_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts."""
    return pii.redact(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with words to take and training positions,
    range-sorted by position."""
    mixed = mixing.mix(docs).where("taken > 0").select("doc_id", "source", "size", "source_size", "target", "taken", "position", "position_2")
    return mixed.repartitionByRange(F.col("position").asc_nulls_last(), "doc_id").sortWithinPartitions(F.col("position").asc_nulls_last(), "doc_id")


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram jaccard join", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("personal data", personal_data_stage),
    ("mixing sources", mixing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


#: The stages fit models and verify hashed candidates, which SQL does not express.
ORACLE_SQL = None
