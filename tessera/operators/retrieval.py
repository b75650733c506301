"""Recall-stage evaluation of an item-to-item table.

For each user, events are ordered by time (ties by item); the item of event
``t + 1`` is the truth for the recommendation list of the item of event
``t``.  A list is the candidates of ``item1`` by descending score (ties by
``item2``).  For every cut-off ``k``:

* hit when the truth is at position ``pos <= k`` of the list;
* ``ndcg = 1 / log2(pos + 1)`` (the gain cancels; relevance 0 gives 0);
* ``mrr = 1 / pos``; ``tp = hit``; ``tp + fn = 1``; ``tp + fp = min(k, len)``.

Totals per ``k``: ``precision = sum(tp) / sum(tp + fp)`` (0 when no list),
``recall = sum(tp) / pairs``, ``f1 = 2pr / (p + r + 1e-8)``,
``mrr = sum(mrr) / pairs``, ``ndcg = sum(ndcg) / pairs``.  An item without a
list counts as a miss.

Plan: a position scan per user and a (user, position + 1) self-join, one
equi-join on (item, truth) against
the list positions, one join with list lengths, an ``explode`` of the k
values and one aggregate -- no per-user Python, nothing collected.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scan import ordered_scan, written
from tessera.operators.topn import tie_key



def rec_lists(i2i: DataFrame) -> DataFrame:
    """F1: (item1, item2, pos) with pos 1.. by score desc, item2 asc.

    A skew-safe scan: with rank ties an item's list is not bounded by N.
    """
    r = ordered_scan(written(i2i.select("item1", "item2", "score")), ["item1"],
                     [tie_key("score").desc(), F.col("item2").asc()], pos="pos")
    return r.select("item1", "item2", "pos")


def next_item_truth(behaviour: DataFrame) -> DataFrame:
    """(user, item, timestamp, truth, truth_relevance) -- the next event's item.

    Events get their position in the user's time order (ties by item) from an
    ordered scan, and event ``p`` is joined with event ``p + 1`` on
    (user, position): a user with a large share of all events is not one
    task's window.
    """
    pos = ordered_scan(written(behaviour.select("user", "item", "relevance", "timestamp")),
                       ["user"], [F.col("timestamp").asc(), F.col("item").asc()], pos="__pos")
    nxt = pos.select("user", (F.col("__pos") - 1).alias("__pos"), F.col("item").alias("truth"),
                     F.col("relevance").alias("truth_relevance"))
    return pos.join(nxt, ["user", "__pos"]).select("user", "item", "timestamp", "truth", "truth_relevance")


def label_predictions(behaviour: DataFrame, i2i: DataFrame) -> DataFrame:
    """(user, item, truth, truth_relevance, pos or null, n_recs)."""
    lists = rec_lists(i2i)
    lengths = lists.groupBy("item1").agg(F.count(F.lit(1)).alias("n_recs"))
    pairs = next_item_truth(behaviour)
    hit = lists.select(F.col("item1").alias("item"), F.col("item2").alias("truth"), "pos")
    return (pairs.join(hit, ["item", "truth"], "left")
            .join(lengths.withColumnRenamed("item1", "item"), "item", "left")
            .withColumn("n_recs", F.coalesce(F.col("n_recs"), F.lit(0))))


def hit_metrics(labeled: DataFrame, ks: Sequence[int]) -> DataFrame:
    """per (pair, k): tp, tpfp, mrr, ndcg."""
    k = F.explode(F.array(*[F.lit(int(x)) for x in ks])).alias("k")
    x = labeled.select("*", k)
    hit = F.col("pos").isNotNull() & (F.col("pos") <= F.col("k"))
    return x.select(
        "k",
        F.when(hit, 1).otherwise(0).cast("long").alias("tp"),
        F.least(F.col("k"), F.col("n_recs")).cast("long").alias("tpfp"),
        F.when(hit, 1.0 / F.col("pos")).otherwise(0.0).alias("mrr"),
        F.when(hit & (F.col("truth_relevance") != 0),
               1.0 / F.log2(F.col("pos") + 1.0)).otherwise(0.0).alias("ndcg"))


def retrieval_metrics(behaviour: DataFrame, i2i: DataFrame,
                      ks: Sequence[int] = (1, 2, 4, 8)) -> DataFrame:
    """(k, precision, recall, f1, mrr, ndcg, n_pairs)."""
    h = hit_metrics(label_predictions(behaviour, i2i), ks)
    t = h.groupBy("k").agg(F.sum("tp").alias("tp"), F.sum("tpfp").alias("tpfp"),
                           F.count(F.lit(1)).alias("n_pairs"),
                           F.sum("mrr").alias("mrr"), F.sum("ndcg").alias("ndcg"))
    p = F.when(F.col("tpfp") > 0, F.col("tp") / F.col("tpfp")).otherwise(0.0)
    r = F.col("tp") / F.col("n_pairs")
    return t.select(
        "k", p.alias("precision"), r.alias("recall"),
        (2 * p * r / (p + r + F.lit(1e-8))).alias("f1"),
        (F.col("mrr") / F.col("n_pairs")).alias("mrr"),
        (F.col("ndcg") / F.col("n_pairs")).alias("ndcg"),
        "n_pairs")
