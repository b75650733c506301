"""Frequent itemsets and rules of any size, level by level.

A level holds, as tables, the frequent itemsets of its size and their occurrences (tid, head, last): the transactions that hold
an itemset, written as its first items and its last one in item order.  The next level comes from it in four steps:

1. prefix join: two frequent itemsets with the same head make a candidate, head + smaller last + larger last;
2. subset pruning: the candidates' other subsets are anti-joined with the frequent itemsets; a candidate with a
   missing one is dropped before anything is counted;
3. occurrences of one transaction with the same head are paired (equi-join on tid and head) and kept where the pair is
   a candidate;
4. counts by itemset with map-side combine, and a filter by ``min_count``.

Pairs need no candidates: every co-occurring pair of frequent items is counted once, with large baskets split into blocks
(``pairs.group_pairs``).  Every level is written to the shared checkpoint folder, which cuts the lineage; the driver sees one
number a level and stops at ``max_size`` or at a level without itemsets.  Nothing is collected, and no task holds
more than a block of one transaction.

Defined cases: null transactions or items are left out, repeated items count once, items are ordered as Spark orders their type, and an
empty table gives no itemsets.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.pairs import group_pairs
from tessera.session import ensure_checkpoint_dir


class _Levels:
    def __init__(self, spark):
        self.spark, self.folder = spark, f"{ensure_checkpoint_dir(spark)}/itemsets-{uuid4().hex}"

    def write(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")


def candidates(frequent: DataFrame) -> DataFrame:
    """(head, last) of the itemsets one larger all of whose subsets are in ``frequent`` (head, last, freq)."""
    f = frequent.select("head", "last")
    joined = (f.join(f.withColumnRenamed("last", "more"), "head").where("last < more")
              .select(F.concat("head", F.array("last")).alias("head"), F.col("more").alias("last")))
    # subsets without one of the head's items but its last: the two others are what was joined
    left_out = F.explode(F.sequence(F.lit(0), F.size("head") - 2))
    subsets = (joined.where(F.size("head") > 1).select("head", "last", left_out.alias("i"))
               .select("head", "last", F.expr("filter(head, (x, j) -> j <> i)").alias("sub")))
    known = f.select(F.col("head").alias("sub"), F.col("last"))
    broken = subsets.join(known, ["sub", "last"], "left_anti").select("head", "last").distinct()
    return joined.join(broken, ["head", "last"], "left_anti")


def level_itemsets(df: DataFrame, tid: str, items: str = "items", min_count: int = 3, max_size: int = 3,
                   block_size: int = 512) -> DataFrame:
    """(items array in item order, freq) of all itemsets of at most ``max_size`` items in at least ``min_count`` transactions.

    ``df`` has one row per transaction: its id and its array of items.
    """
    if min_count < 1 or max_size < 1:
        raise ValueError("min_count and max_size must be >= 1")
    levels = _Levels(df.sparkSession)
    rows = levels.write("rows", df.select(F.col(tid).alias("tid"), F.explode(F.array_distinct(items)).alias("item"))
                        .where("tid IS NOT NULL AND item IS NOT NULL").distinct())
    kind = dict(rows.dtypes)["item"]
    none = F.array().cast(f"array<{kind}>")
    count = lambda x: x.groupBy("head", "last").agg(F.count(F.lit(1)).alias("freq")).where(F.col("freq") >= min_count)
    frequent = levels.write("frequent1", count(rows.select(none.alias("head"), F.col("item").alias("last"))))
    found, size, held = [frequent], 1, None
    while size < max_size and not frequent.isEmpty():
        size += 1
        if size == 2:
            kept = rows.join(frequent.select(F.col("last").alias("item")), "item", "left_semi")
            kept = kept.join(kept.groupBy("tid").agg(F.count(F.lit(1)).alias("n")), "tid")
            pairs = group_pairs(kept, ["tid"], "item", "n", (), block_size)
            held = levels.write("held2", pairs.select("tid", F.array("item_lo").alias("head"), F.col("item_hi").alias("last")))
        else:
            # occurrences of what turned out not to be frequent are of no use any more
            now = held.join(frequent.select("head", "last"), ["head", "last"], "left_semi")
            wanted = levels.write(f"candidates{size}", candidates(frequent))
            pairs = (now.join(now.withColumnRenamed("last", "more"), ["tid", "head"]).where("last < more")
                     .select("tid", F.concat("head", F.array("last")).alias("head"), F.col("more").alias("last")))
            held = levels.write(f"held{size}", pairs.join(wanted, ["head", "last"], "left_semi"))
        frequent = levels.write(f"frequent{size}", count(held))
        found.append(frequent)
    out = [f.select(F.concat("head", F.array("last")).alias("items"), "freq") for f in found]
    every = out[0]
    for f in out[1:]:
        every = every.unionByName(f)
    return every


def itemset_rules(itemsets: DataFrame, n_transactions: int, min_confidence: float = 0.1) -> DataFrame:
    """(antecedent array, consequent, confidence, lift, support) of all rules with one consequent.

    ``itemsets`` (items, freq) must hold the subsets of its itemsets, as ``level_itemsets`` and FP-growth give them.
    """
    each = (itemsets.where(F.size("items") > 1).select("items", "freq", F.explode("items").alias("consequent"))
            .select(F.array_sort(F.expr("filter(items, x -> x <> consequent)")).alias("antecedent"), "consequent", "freq"))
    known = itemsets.select(F.array_sort("items").alias("antecedent"), F.col("freq").alias("n_a"))
    single = itemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("consequent"), F.col("freq").alias("n_c"))
    n = F.lit(float(n_transactions))
    confidence = F.col("freq").cast("double") / F.col("n_a")
    return (each.join(known, "antecedent").join(single, "consequent").where(confidence >= min_confidence)
            .select("antecedent", "consequent", confidence.alias("confidence"), (confidence / (F.col("n_c") / n)).alias("lift"),
                    (F.col("freq") / n).alias("support")))
