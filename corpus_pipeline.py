"""Corpus pipeline: the documents table through five of the training-data operators, each stage written as Parquet."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import stages
from tessera.session import ensure_checkpoint_dir

STAGES = [
    ("language_id", stages.language_id),
    ("line_dedup", stages.line_dedup),
    ("near_dedup", stages.near_dedup),
    ("decontaminate", stages.decontaminate),
    ("mix_sources", stages.mix_sources),
]

#: Language ID learns a model, which SQL cannot express; tests compare the other stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read back as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
