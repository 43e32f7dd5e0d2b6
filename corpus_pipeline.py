"""The training-data pipeline: documents in, packed token sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strandline.llm import decontaminate, langid, neardup, packing, pii


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is not identified go."""
    return langid.keep_identified(docs)


def duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return neardup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def privacy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts gives way to placeholders."""
    return pii.mask(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two lengths, none across documents."""
    return packing.pack(docs)


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pii", privacy_stage),
    ("packing", packing_stage),
]

#: Trained models, components and tokenizers can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn over the whole of ``documents``."""
    from strandline.llm.shared import materialize

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
