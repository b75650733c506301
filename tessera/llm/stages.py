"""The pipeline's stages: (spark, docs, sf_dir) -> documents that go on, each by one of the operators.

All but the last return the columns of documents.  Empty inputs give empty results; rows that repeat an id are kept or dropped
together, except that line dedup treats each row's text on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate as op1
from tessera.llm import language_id as op8
from tessera.llm import line_dedup as op6
from tessera.llm import mixing as op7
from tessera.llm import near_dedup as op2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known: those with a letter, for which one learned language is likelier than all others."""
    model = op8.train(docs.where(~op8.held_out()))
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}  # documents may have columns named like the result's
    known = model.predict(docs.toDF(*names.values()), names["text"]).where((F.col("lang_pred") != "und") & (F.col("score") >= 0.5))
    return known.select(*[F.col(n).alias(c) for c, n in names.items()])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a larger document repeats; n_chars follows the text."""
    out = op6.line_dedup(docs).withColumn("text", F.col("__kept")).withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near-duplicates."""
    gone = op2.near_dedup(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == F.col("__gone"), "left_anti")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words stand in 13-word windows of benchmark items."""
    return op1.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their place in the mixed stream; sources weigh as the square root of their size."""
    return op7.mix(docs)
