"""Queries of the numbered operators over the given tables, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import conversation as op11
from tessera.llm import decontaminate as op1
from tessera.llm import exact_dedup as op5
from tessera.llm import fim as op12
from tessera.llm import language_id as op8
from tessera.llm import license_scan as op9
from tessera.llm import line_dedup as op6
from tessera.llm import lm_score as op10
from tessera.llm import mixing as op7
from tessera.llm import near_dedup as op2
from tessera.llm import pii as op3
from tessera.llm import quality as op13
from tessera.llm import warc as op4


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a 13-word window of a benchmark item."""
    return op1.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("__tk")


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document; the smallest id of each stays."""
    return op2.near_dedup(_table(spark, sf_dir, "documents"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: spans of the fixed patterns and those that the field adds."""
    docs = _table(spark, sf_dir, "documents")
    return op3.find_pii(docs, op3.train(docs)).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives; a page id stands for the seconds at which it was captured."""
    pages = _table(spark, sf_dir, "pages").withColumn("ts", F.timestamp_seconds(F.col("page_id") + 1_700_000_000))
    return op4.archive_and_index(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the row of each that stays."""
    return op5.exact_dedup(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that larger documents repeat, and a digest of what is left."""
    out = op6.line_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
                      F.sha2("__kept", 256).alias("kept_sha256"))


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mixed stream; sources weigh as the square root of their size."""
    return op7.mix(_table(spark, sf_dir, "documents")).drop("text", "lang", "n_chars")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from documents that are not held out."""
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", op8.held_out())
    return op8.train(docs.where(~F.col("held_out"))).predict(docs, keep=["doc_id", "held_out"])


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices of every document."""
    return op9.license_scan(_table(spark, sf_dir, "documents")).drop("spans")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram and bigram scores of every document, learned from documents that are not held out."""
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", op10.held_out())
    return op10.lm_score(docs, docs.where(~F.col("held_out"))).withColumn("held_out", op10.held_out())


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest structure repair of every conversation after the contract's damage."""
    chats = _table(spark, sf_dir, "conversations")
    return op11.repair_report(op11.damage(chats), chats)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a line span moved behind its prefix and suffix, and the text rebuilt from that form."""
    forms = op12.restored(op12.fill_in_middle(_table(spark, sf_dir, "documents")))
    return forms.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2("restored", 256).alias("restored_sha256"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of held-out documents are not learned from."""
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", op13.held_out())
    model = op13.QualityModel(docs, _table(spark, sf_dir, "labels").where(~op13.held_out()))
    return model.score(docs, keep=["doc_id", "held_out"]).withColumn("predicted", op13.predicted())


QUERIES = {f.__name__: f for f in (op1_decontaminate, op2_near_dedup, op3_pii, op4_warc, op5_exact_dedup, op6_line_dedup,
                                 op7_mix_sources, op8_language_id, op9_license_scan, op10_lm_score, op11_repair_conversations, op12_fill_in_middle, op13_quality)}
ORACLES = {"op1_decontaminate": op1.ORACLE, "op2_near_dedup": op2.ORACLE, "op4_warc": op4.ORACLE, "op5_exact_dedup": op5.ORACLE,
           "op6_line_dedup": op6.ORACLE, "op9_license_scan": op9.ORACLE, "op11_repair_conversations": op11.ORACLE,
           "op12_fill_in_middle": op12.ORACLE}
