"""List-wise ranking metrics on long tables.

Input is one row per (list, item): ``list_id, item_id, label, score`` and an
optional per-item ``weight`` (1.0 when absent).  Labels below 0 are invalid:
their label counts as 0 and their score as the list minimum minus 1e-6, so
they sort last.  Items are ranked by score descending with ties broken by
``item_id`` (deterministic, unlike a random shuffle of ties).  ``n=None``
means the whole list.

Every metric returns a per-list table ``(list_id, <metric>, weight)``;
``weighted_mean`` turns it into ``sum(metric * weight) / sum(weight)``.  The
per-list weight (G2) is ``sum(w * rel) / sum(rel)`` over the list's items;
lists without relevance get the average weight of the lists with some,
averaged over the whole input.  ``rel`` is ``[label >= 1]`` for MRR, P, MAP,
``2^label - 1`` for NDCG / DCG, and ``[any subtopic label >= 1]`` for the
diversity metrics.

Positions and running sums come from ``ordered_scan``, which stays balanced
even when one list holds a large share of all rows; per-list totals are
plain aggregates with map-side partial aggregation.  Nothing builds item
pairs: OPA counts dominated items over dyadic ranges of label ranks.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scan import hot_groups, ordered_scan
from tessera.operators.topn import first_rows

LN2 = 0.6931471805599453


def default_gain(label: Column) -> Column:
    return F.pow(F.lit(2.0), label) - F.lit(1.0)


def default_discount(rank: Column) -> Column:
    return F.lit(LN2) / F.log1p(rank.cast("double"))


def prepare_lists(df: DataFrame, list_col: str = "list_id", item_col: str = "item_id",
                  label: str = "label", score: str = "score",
                  weight: str | None = "weight") -> DataFrame:
    """G1: (list_id, item_id, label, score, weight, valid) with cleaned values."""
    w = (F.col(weight).cast("double") if weight and weight in df.columns else F.lit(1.0))
    base = df.select(F.col(list_col).alias("list_id"), F.col(item_col).alias("item_id"),
                     F.col(label).cast("double").alias("raw_label"),
                     F.col(score).cast("double").alias("raw_score"), w.alias("weight"))
    mins = base.groupBy("list_id").agg(F.min("raw_score").alias("__min"))
    valid = F.col("raw_label") >= 0
    return (base.join(mins, "list_id")
            .select("list_id", "item_id",
                    F.when(valid, F.col("raw_label")).otherwise(0.0).alias("label"),
                    F.when(valid, F.col("raw_score"))
                    .otherwise(F.col("__min") - F.lit(1e-6)).alias("score"),
                    "weight", valid.alias("valid")))


def rank_lists(prepared: DataFrame, sums=(), method: str = "auto", n: int | None = None, **kw) -> DataFrame:
    """Adds ``pos`` (1-based by score desc, item asc) and running sums; with ``n`` only the first n rows are left."""
    return first_rows(prepared, ["list_id"], [F.col("score").desc(), F.col("item_id").asc()], n,
                      sums, method=method, **kw)


def _hot_lists(rows: DataFrame, n: int | None, method: str) -> dict:
    """Lists that scans must split, found once for all scans of a metric."""
    return {"hot": hot_groups(rows, ["list_id"])} if n is None and method == "auto" else {}


def list_weights(df: DataFrame, rel: Column) -> DataFrame:
    """(list_id, weight) from per-item weights and relevance ``rel``."""
    per = df.groupBy("list_id").agg(F.sum(F.col("weight") * rel).alias("__wr"),
                                    F.sum(rel).alias("__r"))
    pw = F.when(F.col("__r") > 0, F.col("__wr") / F.col("__r")).otherwise(0.0)
    per = per.select("list_id", "__r", pw.alias("__pw"))
    avg = per.agg(F.sum("__pw").alias("__sw"),
                  F.sum(F.when(F.col("__r") > 0, 1).otherwise(0)).alias("__nz"))
    avg_w = F.when(F.col("__nz") > 0, F.col("__sw") / F.col("__nz")).otherwise(0.0)
    return (per.crossJoin(F.broadcast(avg))  # one-row aggregate
            .select("list_id", F.when(F.col("__r") > 0, F.col("__pw")).otherwise(avg_w)
                    .alias("weight")))


def weighted_mean(per_list: DataFrame, metric: str, weight: str = "weight") -> DataFrame:
    """``sum(metric * weight) / sum(weight)`` as a one-row DataFrame."""
    return per_list.agg(
        F.when(F.sum(weight) != 0, F.sum(F.col(metric) * F.col(weight)) / F.sum(weight))
        .otherwise(0.0).alias(metric))


def _binary_rel():
    return F.when(F.col("label") >= 1.0, 1.0).otherwise(0.0)


def mrr(prepared: DataFrame, n: int | None = None, method: str = "auto") -> DataFrame:
    """Max over the top n of [label >= 1] / rank."""
    r = rank_lists(prepared, method=method, n=n)
    m = r.groupBy("list_id").agg(F.max(F.when(F.col("label") >= 1.0, 1.0 / F.col("pos")).otherwise(0.0)).alias("mrr"))
    return m.join(list_weights(prepared, _binary_rel()), "list_id")


def arp(prepared: DataFrame, method: str = "auto") -> DataFrame:
    """Average relevance position, position weighted by label * weight."""
    r = rank_lists(prepared, method=method)
    rel = F.col("label") * F.col("weight")
    return (r.groupBy("list_id")
            .agg(F.sum(F.col("pos") * rel).alias("__pr"), F.sum(rel).alias("weight"))
            .select("list_id", F.when(F.col("weight") != 0, F.col("__pr") / F.col("weight"))
                    .otherwise(0.0).alias("arp"), "weight"))


def precision_at(prepared: DataFrame, n: int | None = None, method: str = "auto") -> DataFrame:
    """Relevant share of the top n (divisor = rows kept)."""
    r = rank_lists(prepared, method=method, n=n)
    p = r.groupBy("list_id").agg(F.avg(_binary_rel()).alias("precision"))
    return p.join(list_weights(prepared, _binary_rel()), "list_id")


def mean_average_precision(prepared: DataFrame, n: int | None = None,
                           method: str = "auto") -> DataFrame:
    """Weighted precision at relevant ranks / weighted relevant count in n."""
    x = prepared.withColumn("rel", _binary_rel())
    r = rank_lists(x, sums=["rel"], method=method, n=n)
    prec = F.col("cum_rel") / F.col("pos")
    t = r.groupBy("list_id").agg(F.sum(prec * F.col("weight") * F.col("rel")).alias("__tp"),
                                 F.sum(F.col("weight") * F.col("rel")).alias("__tr"))
    m = t.select("list_id", F.when(F.col("__tr") != 0, F.col("__tp") / F.col("__tr"))
                 .otherwise(0.0).alias("map"))
    return m.join(list_weights(prepared, _binary_rel()), "list_id")


def dcg_terms(ranked: DataFrame, pos: str = "pos",
              gain: Callable[[Column], Column] = default_gain,
              discount: Callable[[Column], Column] = default_discount) -> Column:
    """Per-row DCG term ``weight * gain(label) * discount(rank)``."""
    return F.col("weight") * gain(F.col("label")) * discount(F.col(pos))


def _dcg(prepared, n, gain, discount, method, **kw):
    r = rank_lists(prepared, method=method, n=n, **kw)
    return r.groupBy("list_id").agg(F.sum(dcg_terms(r, "pos", gain, discount)).alias("dcg"))


def ndcg(prepared: DataFrame, n: int | None = None,
         gain: Callable[[Column], Column] = default_gain,
         discount: Callable[[Column], Column] = default_discount,
         method: str = "auto") -> DataFrame:
    """DCG over the ideal DCG (ideal order by weight * label)."""
    hot = _hot_lists(prepared, n, method)
    dcg = _dcg(prepared, n, gain, discount, method, **hot)
    ideal = first_rows(prepared.withColumn("__ideal", F.col("weight") * F.col("label")),
                       ["list_id"], [F.col("__ideal").desc(), F.col("item_id").asc()], n, method=method, **hot)
    idcg = ideal.groupBy("list_id").agg(F.sum(dcg_terms(ideal, "pos", gain, discount)).alias("idcg"))
    m = dcg.join(idcg, "list_id").select(
        "list_id", F.when(F.col("idcg") != 0, F.col("dcg") / F.col("idcg")).otherwise(0.0).alias("ndcg"))
    return m.join(list_weights(prepared, gain(F.col("label"))), "list_id")


def dcg(prepared: DataFrame, n: int | None = None,
        gain: Callable[[Column], Column] = default_gain,
        discount: Callable[[Column], Column] = default_discount,
        method: str = "auto") -> DataFrame:
    """DCG divided by the list weight."""
    d = _dcg(prepared, n, gain, discount, method).join(
        list_weights(prepared, gain(F.col("label"))), "list_id")
    return d.select("list_id", F.when(F.col("weight") != 0, F.col("dcg") / F.col("weight"))
                    .otherwise(0.0).alias("dcg"), "weight")


def _opa_scan(p: DataFrame, method: str, hot: dict, keep=()) -> DataFrame:
    """Items once per bit of their list's ranks, with the points below each in its dyadic node (``cum___point``)."""
    levels = p.select("list_id", "item_id", "score", "weight", *keep, "__r", F.explode(F.expr("sequence(0, __bits - 1)")).alias("__b"))
    bit = F.expr("shiftright(__r, __b) & 1")
    nodes = levels.select("list_id", "__b", F.expr("shiftright(__r, __b + 1)").alias("__node"), "score", "item_id", "weight", *keep,
                          (1 - bit).cast("double").alias("__point"))
    # at equal score questions come before points: only strictly lower scores count
    return ordered_scan(nodes, ["list_id", "__b", "__node"], [F.col("score").asc(), F.col("__point").asc(), F.col("item_id").asc()],
                        ["__point"], method=method, **hot)


def opa(prepared: DataFrame, method: str = "auto") -> DataFrame:
    """Ordered pair accuracy.

    Over valid pairs (i, j) of a list with label_i > label_j, the share with
    score_i > score_j, pairs weighted by the weight of i.  Per valid item
    ``P_i = #{j: l_j < l_i}`` and ``C_i = #{j: l_j < l_i, s_j < s_i}``.

    Dominance counting over dyadic ranges of label ranks.  A list's labels get
    dense ranks r from 0 (``P_i`` comes with them).  [0, r) is the disjoint union of the left halves
    of the dyadic nodes in which r lies in the right half, one for every bit that is set in r.  So on
    every level b each item belongs to one node ``r >> (b + 1)``: as a point when
    bit b is 0, as a question when it is 1.  One ordered scan by score inside (list, level, node) counts the
    points below every question.  An item has one row per bit of the list's
    highest rank: n log2(grades) rows, never items x grades and never pairs.

    Without lists that scans must split, ranks of labels and the lists' totals are windows over the items, which are read once.
    With them they come from the grades' counts, joined to the items, and from an aggregate of its own.
    """
    v = prepared.filter("valid").select("list_id", "item_id", "label", "score", "weight")
    hot = _hot_lists(v, None, method)
    bits = F.ceil(F.log2(F.col("__grades").cast("double"))).cast("int").alias("__bits")
    if method == "window" or (hot and hot["hot"] is None):
        w = Window.partitionBy("list_id")
        ranked = v.filter(F.col("list_id").isNotNull()).select(
            "*", F.dense_rank().over(w.orderBy("label")).alias("__r"), (F.rank().over(w.orderBy("label")) - 1).alias("__p"))
        p = ranked.select("*", F.max("__r").over(w).alias("__grades"), F.sum(F.col("weight") * F.col("__p")).over(w).alias("__t")).select(
            "list_id", "item_id", "score", "weight", (F.col("__r") - 1).cast("int").alias("__r"), bits, "__t")
        # a list of one grade has points only, which keep its row
        sc = _opa_scan(p.withColumn("__bits", F.greatest("__bits", F.lit(1))), method, hot, ["__t"])
        t = sc.groupBy("list_id").agg(F.max("__t").alias("weight"), F.sum(
            F.when(F.col("__point") == 0, F.col("weight") * F.col("cum___point"))).alias("__c"))
    else:
        per_grade = v.groupBy("list_id", "label").agg(F.count(F.lit(1)).alias("__cnt"))
        ranked = ordered_scan(per_grade, ["list_id"], ["label"], ["__cnt"], pos="__r", method=method, **hot)
        grades = ranked.groupBy("list_id").agg(F.max("__r").alias("__grades"))
        ranked = ranked.join(grades, "list_id").select(
            "list_id", "label", (F.col("__r") - 1).cast("int").alias("__r"), bits, (F.col("cum___cnt") - F.col("__cnt")).alias("__p"))
        p = v.join(ranked, ["list_id", "label"])
        # lists of one grade have no pairs and no bits
        sc = _opa_scan(p.filter("__bits > 0"), method, hot)
        c = sc.filter("__point = 0").groupBy("list_id").agg(F.sum(F.col("weight") * F.col("cum___point")).alias("__c"))
        t = p.groupBy("list_id").agg(F.sum(F.col("weight") * F.col("__p")).alias("weight")).join(c, "list_id", "left")
    return t.select("list_id", F.when(F.col("weight") != 0, F.coalesce("__c", F.lit(0.0)) / F.col("weight"))
                    .otherwise(0.0).alias("opa"), "weight")


# ---------------------------------------------------------------- diversity

def prepare_diversity(df: DataFrame, list_col: str = "list_id", item_col: str = "item_id",
                      subtopic: str = "subtopic", label: str = "label", score: str = "score",
                      weight: str | None = "weight"):
    """(items, cells).

    ``items``: (list_id, item_id, score, weight, valid, any_rel) -- an item is
    valid when any of its subtopic labels is >= 0; invalid items get the list
    minimum score minus 1e-6.  ``cells``: (list_id, item_id, subtopic, label)
    with invalid labels as 0.
    """
    w = (F.col(weight).cast("double") if weight and weight in df.columns else F.lit(1.0))
    base = df.select(F.col(list_col).alias("list_id"), F.col(item_col).alias("item_id"),
                     F.col(subtopic).alias("subtopic"), F.col(label).cast("double").alias("label"),
                     F.col(score).cast("double").alias("score"), w.alias("weight"))
    items = base.groupBy("list_id", "item_id").agg(
        # rows of an item that differ: the largest, whatever the row order
        F.max("score").alias("raw_score"), F.max("weight").alias("weight"),
        F.max(F.when(F.col("label") >= 0, 1).otherwise(0)).alias("__valid"),
        F.max(F.when(F.col("label") >= 1, 1.0).otherwise(0.0)).alias("any_rel"))
    mins = items.groupBy("list_id").agg(F.min("raw_score").alias("__min"))
    items = items.join(mins, "list_id").select(
        "list_id", "item_id",
        F.when(F.col("__valid") == 1, F.col("raw_score")).otherwise(F.col("__min") - 1e-6).alias("score"),
        "weight", (F.col("__valid") == 1).alias("valid"), "any_rel")
    cells = base.select("list_id", "item_id", "subtopic",
                        F.when(F.col("label") >= 0, F.col("label")).otherwise(0.0).alias("label"))
    return items, cells


def precision_ia(items: DataFrame, cells: DataFrame, n: int | None = None,
                 method: str = "auto") -> DataFrame:
    """Relevant (item, subtopic) cells in the top n / (subtopics x items kept)."""
    r = rank_lists(items, method=method, n=n)
    kept = r.groupBy("list_id").agg(F.count(F.lit(1)).alias("__kept"))
    hits = (cells.filter(F.col("label") >= 1).join(r.select("list_id", "item_id"),
                                                   ["list_id", "item_id"])
            .groupBy("list_id").agg(F.count(F.lit(1)).alias("__hits")))
    topics = (cells.filter(F.col("label") >= 1).groupBy("list_id")
              .agg(F.countDistinct("subtopic").alias("__topics")))
    m = (kept.join(hits, "list_id", "left").join(topics, "list_id", "left")
         .fillna(0, ["__hits", "__topics"]))
    den = F.col("__kept") * F.col("__topics")
    m = m.select("list_id", F.when(den != 0, F.col("__hits") / den).otherwise(0.0).alias("precision_ia"))
    return m.join(list_weights(items, F.col("any_rel")), "list_id")


def alpha_dcg(items: DataFrame, cells: DataFrame, n: int | None = None, alpha: float = 0.5,
              discount: Callable[[Column], Column] = default_discount,
              method: str = "auto") -> DataFrame:
    """Alpha-DCG; gain = sum_t label * (1 - alpha)^(earlier coverage of t)."""
    # no scan has more rows of a list than cells has: its lists are counted once, before any join
    hot = _hot_lists(cells, None, method)
    r = rank_lists(items, method=method, n=n, **(hot if n is None else {})).select("list_id", "item_id", "pos", "weight")
    c = cells.join(r, ["list_id", "item_id"])
    cov = ordered_scan(c, ["list_id", "subtopic"], [F.col("pos").asc()], ["label"],
                       pos="__spos", method=method, **hot)
    earlier = F.col("cum_label") - F.col("label")
    cell_gain = F.col("label") * F.pow(F.lit(1.0 - alpha), earlier)
    per_item = cov.groupBy("list_id", "item_id", "pos", "weight").agg(F.sum(cell_gain).alias("__g"))
    d = per_item.groupBy("list_id").agg(
        F.sum(F.col("weight") * F.col("__g") * discount(F.col("pos"))).alias("__adcg"))
    d = d.join(list_weights(items, F.col("any_rel")), "list_id")
    return d.select("list_id", F.when(F.col("weight") != 0, F.col("__adcg") / F.col("weight"))
                    .otherwise(0.0).alias("alpha_dcg"), "weight")


def ndcg_report(prepared: DataFrame, ns=(1, 4, 8, 20, None),
                gain: Callable[[Column], Column] = default_gain,
                discount: Callable[[Column], Column] = default_discount,
                method: str = "auto") -> DataFrame:
    """G8 at several cut-offs at once (the evaluation set 1, 4, 8, 20, all):
    one row of weighted means ``ndcg_<n>`` / ``ndcg_all``.

    One scan for the predicted order and one for the ideal order serve every
    cut-off; each is a conditional sum in one per-list aggregate.
    """
    def name(n):
        return "ndcg_all" if n is None else f"ndcg_{n}"

    def cut(col, n):
        return F.lit(True) if n is None else (F.col(col) <= n)

    hot = _hot_lists(prepared, None, method)
    r = rank_lists(prepared, method=method, **hot)
    t = dcg_terms(r, "pos", gain, discount)
    d = r.groupBy("list_id").agg(*[F.sum(F.when(cut("pos", n), t).otherwise(0.0)).alias(f"d_{i}")
                                   for i, n in enumerate(ns)])
    ideal = ordered_scan(prepared.withColumn("__ideal", F.col("weight") * F.col("label")),
                         ["list_id"], [F.col("__ideal").desc(), F.col("item_id").asc()],
                         pos="ipos", method=method, **hot)
    ti = dcg_terms(ideal, "ipos", gain, discount)
    i = ideal.groupBy("list_id").agg(*[F.sum(F.when(cut("ipos", n), ti).otherwise(0.0)).alias(f"i_{k}")
                                       for k, n in enumerate(ns)])
    w = list_weights(prepared, gain(F.col("label")))
    per = d.join(i, "list_id").join(w, "list_id")
    per = per.select("weight", *[F.when(F.col(f"i_{k}") != 0, F.col(f"d_{k}") / F.col(f"i_{k}"))
                                 .otherwise(0.0).alias(name(n)) for k, n in enumerate(ns)])
    tot = F.sum("weight")
    return per.agg(*[F.when(tot != 0, F.sum(F.col(name(n)) * F.col("weight")) / tot).otherwise(0.0)
                     .alias(name(n)) for n in ns])
