"""Operator 5: exact deduplication by 128-bit content hash, bytes compared inside groups.  DataFrame functions only.

``exact_dedup(docs)`` treats texts as equal when they are identical after deleting ASCII blanks (null counts as empty).

1. Rows are aggregated by (128-bit hash of the normalised text, normalised text): the hash decides where a row goes
   and is compared first, the bytes are compared by the aggregation itself, so texts that merely collide stay apart.
   Copies collapse before the shuffle (partial aggregation): a hot group reaches the reducer as one row per map task.
2. Every group keeps its member with the most code points in the original text, then the smallest id.
3. Narrow rows (id, hash, digest) are joined back to the groups; the texts are not shuffled a second time.
   AQE splits the partition of a hot group.

Defined cases: null and blank texts form one group (the empty text); a null id sorts after every other id; repeated rows
are members like any other, and each gets a result row (with repeats of the kept id, each of them counts as kept).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import BLANKS


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: (id, keep_id, group_size, kept, text_sha256)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = F.translate(text, BLANKS, "")
    rows = docs.select(F.col(id_col).alias("__id"), F.length(text).alias("__len"), norm.alias("__norm"))
    keyed = rows.withColumn("__h", F.md5("__norm"))
    # max of (length, -position): nulls last is spelled out by the flag
    rank = F.struct(F.col("__len"), F.col("__id").isNotNull().alias("has_id"), (-F.col("__id")).alias("neg"))
    groups = (keyed.groupBy("__h", "__norm")
              .agg(F.count(F.lit(1)).alias("group_size"), F.max(rank).alias("best"))
              .select("__h", F.sha2("__norm", 256).alias("text_sha256"), "group_size",
                      (-F.col("best.neg")).alias("keep_id")))
    members = rows.select("__id", F.md5("__norm").alias("__h"), F.sha2("__norm", 256).alias("text_sha256"))
    return members.join(groups, ["__h", "text_sha256"]).select(
        F.col("__id").alias(id_col), "keep_id", F.col("group_size").cast("long"),
        F.col("__id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


ORACLE = r"""WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT norm, count(*) AS group_size, arg_max(doc_id, (len, -doc_id)) AS keep_id FROM n GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM n JOIN g USING (norm)"""
