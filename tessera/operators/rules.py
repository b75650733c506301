"""Association rules.

Two plans compute the same one-to-one rules and check each other:

* ``fp_rules`` -- parallel FP-growth (ranks of the items as a table, conditional
  transactions per share of the items, an FP-tree a share) followed by
  a filter to rules with one antecedent and one consequent;
* ``pair_rules`` -- support counting with the skew-split pair join of
  ``pairs.group_pairs`` restricted to frequent items, then
  ``conf = n_ab / n_a`` and ``lift = conf / (n_b / N)``.

Both keep the top ``n`` consequents per antecedent by lift (``rank``, ties
kept).  Lifts are ranked on 34 significant bits (``topn.tie_key``).
"""

from __future__ import annotations

import math
from uuid import uuid4

import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.indexing import global_index
from tessera.operators.itemsets import itemset_rules
from tessera.operators.pairs import placed_pairs
from tessera.operators.topn import tie_key, top_n
from tessera.session import ensure_checkpoint_dir, ship_package

TREE_ITEMS = 150_000  # items of prefixes in the trees of one task: some 2.5 KB each
MAX_TREE_TASKS = 3000
OUT_ROWS = 10_000


def min_support(count: int, n: int) -> float:
    """Support fraction for an absolute count.

    FP-growth turns a fraction back into ``ceil(fraction * n)``; ``count / n``
    may round up to ``count + 1`` in floating point, ``(count - 0.5) / n``
    cannot.
    """
    if n <= 0:
        return 1.0
    return (count - 0.5) / n


def _tree(paths):
    """FP-tree of (items in rank order, count): per node its item, parent and count, and per item its nodes."""
    item, parent, count, nodes, child = [None], [0], [0], {}, {}
    for path, c in paths:
        at = 0
        for i in path:
            nxt = child.get((at, i))
            if nxt is None:
                nxt = child[at, i] = len(item)
                item.append(i)
                parent.append(at)
                count.append(0)
                nodes.setdefault(i, []).append(nxt)
            count[nxt] += c
            at = nxt
    return item, parent, count, nodes


def _grow(paths, least: int, wanted=None):
    """(items, count) of the itemsets of ``paths`` with at least ``least`` transactions; ``wanted`` limits the last items.

    Conditional trees wait on a list, so that a long itemset is no deep recursion.
    """
    open_ = [(paths, (), wanted)]
    while open_:
        paths, suffix, wanted = open_.pop()
        item, parent, count, nodes = _tree(paths)
        for i, at in nodes.items():
            freq = sum(count[n] for n in at)
            if freq < least or (wanted is not None and not wanted(i)):
                continue
            yield (i, *suffix), freq
            prefixes, seen = [], {}
            for n in at:
                path, up = [], parent[n]
                while up:
                    path.append(item[up])
                    up = parent[up]
                if path:
                    prefixes.append((path[::-1], count[n]))
                    for x in path:
                        seen[x] = seen.get(x, 0) + count[n]
            prefixes = [(kept, c) for p, c in prefixes if (kept := [x for x in p if seen[x] >= least])]
            if prefixes:
                open_.append((prefixes, (i, *suffix), None))


def _fpgrowth(df: DataFrame, items: str, min_count: int, partitions: int | None) -> tuple[DataFrame, int]:
    """((items, freq), number of transactions): parallel FP-growth whose item ranks are a table.

    A transaction goes, as the longest prefix of its items by rank that a share of the items asks for, to that share's task, which
    mines the itemsets whose last item is its own.  No list of items or itemsets is on the driver.
    """
    spark = df.sparkSession
    ship_package(spark)
    folder = f"{ensure_checkpoint_dir(spark)}/fp-{uuid4().hex}"

    def written(x, name):
        x.write.parquet(f"{folder}/{name}")
        return spark.read.schema(x.schema).parquet(f"{folder}/{name}")

    size = F.coalesce(F.size(items), F.lit(0)).cast("double")
    # three scalars: the transactions, those with items, and the length of all prefixes that trees are built from
    rows, n, length = df.agg(F.count(F.lit(1)), F.count(items), F.sum(size * (size + 1) / 2)).first()
    least = max(1, math.ceil(min_support(min_count, rows) * n))
    parts = partitions or max(1, min(MAX_TREE_TASKS, math.ceil((length or 0) / TREE_ITEMS)))
    # generated ids are written: a transaction has one
    baskets = written(df.select(F.monotonically_increasing_id().alias("tid"), F.array_distinct(items).alias("items")), "transactions")
    each = baskets.select("tid", F.explode("items").alias("item"))
    counts = each.groupBy("item").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= least)
    ranked = written(global_index(counts, [F.col("c").desc(), F.col("item").asc()], "rank"), "ranks")
    by_rank = (each.join(ranked.select(F.col("item").alias("known"), "rank"), F.col("item").eqNullSafe(F.col("known")))
               .groupBy("tid").agg(F.sort_array(F.collect_list("rank")).alias("path")))
    share = lambda r: F.pmod(r, F.lit(parts)).cast("int")
    # the last place of every share: what follows it is of no use there
    places = by_rank.select("path", F.array_sort(F.transform("path", lambda r, i: F.struct(share(r).alias("s"), i.alias("i")))).alias("places"))
    last = F.filter("places", lambda x, i: F.coalesce(F.get("places", i + 1)["s"] != x["s"], F.lit(True)))
    sent = places.select("path", F.inline(last)).select(F.col("s").alias("share"), F.slice("path", F.lit(1), F.col("i") + 1).alias("path"))
    placed = sent.repartition(parts, "share")

    def mine(batches):
        paths = {}
        for pdf in batches:
            for s, path in zip(pdf["share"].tolist(), pdf["path"]):
                paths.setdefault(s, []).append((path.tolist(), 1))
        found = []
        for s, own in paths.items():
            for ranks, freq in _grow(own, least, lambda r: r % parts == s):
                found.append((list(ranks), freq))
                if len(found) == OUT_ROWS:
                    yield pd.DataFrame(found, columns=["ranks", "freq"])
                    found = []
        if found:
            yield pd.DataFrame(found, columns=["ranks", "freq"])

    sets = written(placed.mapInPandas(mine, "ranks array<long>, freq long").withColumn("sid", F.monotonically_increasing_id()), "sets")
    named = (sets.select("sid", "freq", F.explode("ranks").alias("rank")).join(ranked.select("rank", "item"), "rank")
             .repartition(parts, "sid").groupBy("sid", "freq").agg(F.array_sort(F.collect_list(F.struct(F.col("rank"), F.col("item")))).alias("of")))
    return named.select(F.col("of.item").alias("items"), "freq"), n


def frequent_itemsets(df: DataFrame, items: str = "items", min_count: int = 3,
                      partitions: int | None = None) -> DataFrame:
    """(items, freq) of all itemsets with at least ``min_count`` transactions."""
    return _fpgrowth(df, items, min_count, partitions)[0]


def association_rules(df: DataFrame, items: str = "items", min_count: int = 3,
                      min_confidence: float = 0.1, partitions: int | None = None) -> DataFrame:
    """(antecedent, consequent, confidence, lift, support)."""
    sets, n = _fpgrowth(df, items, min_count, partitions)
    rules = itemset_rules(sets, n, min_confidence)
    return rules.withColumn("consequent", F.array("consequent"))


def one_to_one_rules(rules: DataFrame) -> DataFrame:
    """C4: rules with a single antecedent and consequent, arrays unwrapped."""
    return (rules.filter((F.size("antecedent") == 1) & (F.size("consequent") == 1))
            .select(F.col("antecedent")[0].alias("antecedent"),
                    F.col("consequent")[0].alias("consequent"),
                    "confidence", "lift"))


def top_rules(rules: DataFrame, top: int = 10, ties: str = "rank") -> DataFrame:
    """Top consequents per antecedent by lift."""
    key = tie_key("lift")
    return top_n(rules, "antecedent", [key.desc()], top, ties=ties, tie_break="consequent")


def fp_rules(df: DataFrame, items: str = "items", min_count: int = 3,
             min_confidence: float = 0.1, top: int = 10,
             partitions: int | None = None) -> DataFrame:
    """FP-growth plan -> (antecedent, consequent, lift)."""
    rules = one_to_one_rules(association_rules(df, items, min_count, min_confidence, partitions))
    return top_rules(rules, top).select("antecedent", "consequent", "lift")


def pair_rules(df: DataFrame, items: str = "items", min_count: int = 3,
               min_confidence: float = 0.1, top: int = 10, tid: str | None = None,
               block_size: int = 512) -> DataFrame:
    """C4 alternative plan: one-to-one rules from pair support counts."""
    if tid:
        t = df.select(F.col(tid).alias("tid"), F.array_distinct(F.col(items)).alias("items"))
    else:
        # generated ids are frozen by a reliable checkpoint: every branch below
        # must see the same id for a transaction, also after a lost executor
        ensure_checkpoint_dir(df.sparkSession)
        staged = df.select(F.monotonically_increasing_id().alias("tid"),
                           F.array_distinct(F.col(items)).alias("items"))
        staged.persist(StorageLevel.MEMORY_AND_DISK)  # the checkpoint write reuses it
        t = staged.checkpoint()
        staged.unpersist()
    n_trans = t.agg(F.count(F.lit(1)).alias("n_trans"))  # one row
    e = t.select("tid", F.explode("items").alias("item"))
    counts = e.groupBy("item").agg(F.count(F.lit(1)).alias("n_item"))
    frequent = counts.filter(F.col("n_item") >= min_count)
    # only frequent items can be in a frequent pair: prune before pairing
    ef = e.join(frequent.select("item"), "item", "left_semi")
    sizes = ef.groupBy("tid").agg(F.count(F.lit(1)).alias("n_in_tid"))
    ef = ef.join(sizes, "tid")
    pairs = placed_pairs(ef, ["tid"], "item", "n_in_tid", (), block_size)
    support = (pairs.groupBy("item_lo", "part", "item_hi").agg(F.count(F.lit(1)).alias("n_ab")).drop("part")
               .filter(F.col("n_ab") >= min_count))
    both = support.select(F.explode(F.array(
        F.struct(F.col("item_lo").alias("antecedent"), F.col("item_hi").alias("consequent")),
        F.struct(F.col("item_hi").alias("antecedent"), F.col("item_lo").alias("consequent"))
    )).alias("r"), "n_ab").select("r.antecedent", "r.consequent", "n_ab")
    ca = frequent.select(F.col("item").alias("antecedent"), F.col("n_item").alias("n_a"))
    cb = frequent.select(F.col("item").alias("consequent"), F.col("n_item").alias("n_b"))
    r = (both.join(ca, "antecedent").join(cb, "consequent")
         .crossJoin(F.broadcast(n_trans))
         .withColumn("confidence", F.col("n_ab").cast("double") / F.col("n_a"))
         .withColumn("lift", F.col("confidence") / (F.col("n_b").cast("double") / F.col("n_trans")))
         .filter(F.col("confidence") >= min_confidence))
    return top_rules(r, top).select("antecedent", "consequent", "lift")
