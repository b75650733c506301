"""Operator 2: near-duplicate documents by bottom-k sketches of one hash function.

A document's set are the 64-bit hashes of its distinct 5-word shingles; the sketch is the ``k`` smallest of them.  Documents are
linked when 100 |A and B| >= 85 |A or B|; the result is the connected component of every document.

1. Equal sets (128 bits of set hash) form a class; from here on only class representatives count, so a hot group of copies is
   one row.  Copies collapse before the shuffle.
2. Inverted lists of retained values.  Linked sets have at least ``share`` of the union sketch in common (a binomial tail below
   ``miss``, 39 of 64 values at similarity 0.85; exact for sets of at most k), so two linked sketches meet in the lists of
   their (1 - share) k + 1 rarest values: only those are indexed, and values that one representative has alone not at all.
3. Every list compares all members with one pivot: as many pairs as entries.  Pairs pass the union-sketch estimate
   and are then verified on the full sets.
4. Lists whose members are in one component by now are done.  What is left of lists of at most ``small`` members is
   paired up, without pairs of one component; longer ones are joined into groups by their pivots, and a group's members,
   with their sets, are cut into blocks: each pair of blocks is a group of its own, computes all overlaps as a
   matrix product and returns a spanning forest of the links between components, never the pairs.

Components come from minimum labels with pointer jumping, each round a written table.  Texts are shuffled once, to get the full
sets of the representatives that stand in some list.  Work is quadratic only in members of one long
list that no pivot connects.

Defined cases: documents without text or words have an empty set and are linked with nothing; documents of fewer than five
words have one shingle, the whole sequence; rows that share an id are one node of the graph; a null id is linked with nothing
and kept; an empty table gives no rows.
"""

from __future__ import annotations

import math
from uuid import uuid4

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import add_gram_hashes, blank_words
from tessera.session import ensure_checkpoint_dir


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """(id, set): sorted hashes of the distinct shingles."""
    words = docs.select(F.col(id_col).alias("id"), blank_words(F.col(text_col)).alias("w"))
    grams = add_gram_hashes(words, "w", "g", width)
    n = F.size("w")
    whole = F.array(F.xxhash64("w", n))
    return grams.select("id", F.sort_array(F.when(n == 0, F.array().cast("array<long>")).when(n < width, whole)
                                           .otherwise(F.array_distinct("g"))).alias("set"))


def components(edges: DataFrame, folder: str) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b): the smallest node that can be reached."""
    spark = edges.sparkSession
    edges.select("a", "b").union(edges.select("b", "a")).distinct().write.parquet(f"{folder}/edges")
    both = spark.read.parquet(f"{folder}/edges")
    labels, rounds = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), 0
    while True:
        path = f"{folder}/labels{rounds}"
        labels.write.parquet(path)
        known = spark.read.parquet(path)
        if rounds and known.where("moved").limit(1).count() == 0:
            return known.select("node", "label")
        known = known.select("node", "label")
        near = (both.join(known.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        step = known.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("to"))
        jump = known.select(F.col("node").alias("to"), F.col("label").alias("next"))
        labels = (step.join(jump, "to").select("node", F.least("to", "next").alias("label"),
                                               (F.least("to", "next") < F.col("was")).alias("moved")))
        rounds += 1


def _linked(inter, na, nb, percent: int):
    return 100 * inter >= percent * (na + nb - inter)


def _block_links(percent: int):
    """Links between members of different components in one pair of blocks, as a spanning forest."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, comp = pdf["rep"].to_numpy(), pdf["comp"].to_numpy()
        sizes = np.array([len(s) for s in pdf["set"]])
        values, owner = np.concatenate(pdf["set"].to_list()), np.repeat(np.arange(len(ids)), sizes)
        _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
        shared = counts > 1
        column = np.cumsum(shared) - 1
        use = shared[inverse]
        rows, cols = owner[use], column[inverse[use]]
        order = np.argsort(cols, kind="stable")
        rows, cols = rows[order], cols[order]
        inter = np.zeros((len(ids), len(ids)), "float32")
        width = 4096
        for lo in range(0, int(shared.sum()), width):
            part = slice(*np.searchsorted(cols, [lo, lo + width]))
            x = np.zeros((len(ids), width), "float32")
            x[rows[part], cols[part] - lo] = 1.0
            inter += x @ x.T
        link = _linked(inter, sizes[:, None], sizes[None, :], percent) & (comp[:, None] != comp[None, :])
        root = {}

        def find(c):
            while root.get(c, c) != c:
                c = root[c]
            return c
        out = []
        for i, j in zip(*np.nonzero(np.triu(link, 1))):
            x, y = find(comp[i]), find(comp[j])
            if x != y:
                root[max(x, y)] = min(x, y)
                out.append((ids[i], ids[j]))
        return pd.DataFrame(out, columns=["a", "b"])
    return run


class NearDuplicates:
    """The steps of the module's docstring; tables go to ``folder``."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, k: int, share: float, small: int, block: int):
        # two columns under names of their own: the documents may have any others
        self.docs = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
        self.name, self.id_col, self.text_col, self.width, self.percent = id_col, "__id", "__text", width, percent
        self.k, self.share, self.small, self.block = k, share, small, block
        self.spark = docs.sparkSession
        self.folder = f"{ensure_checkpoint_dir(self.spark)}/near-{uuid4().hex}"
        self.id_type = dict(docs.dtypes)[id_col]

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def sets(self) -> DataFrame:
        return shingle_sets(self.docs, self.id_col, self.text_col, self.width)

    def classes(self) -> None:
        s = F.col("set")
        self.members = self._written("members", self.sets().select(
            "id", F.size(s).alias("n"), F.xxhash64(s).alias("k1"), F.xxhash64(F.lit(1), s).alias("k2"), F.slice(s, 1, self.k).alias("sketch")))
        self.reps = self._written("classes", self.members.where((F.col("n") > 0) & F.col("id").isNotNull()).groupBy("k1", "k2").agg(
            F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))

    def lists(self) -> None:
        entries = self.reps.select("rep", F.size("sketch").alias("size"), F.explode("sketch").alias("v"))
        common = entries.groupBy("v").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
        held = (entries.join(common, "v").groupBy("rep", "size")
                .agg(F.sort_array(F.collect_list(F.struct("c", "v"))).alias("vs")))  # at most k values
        prefix = F.col("size") - F.ceil(F.col("size") * self.share) + 1
        left = F.greatest(prefix - (F.col("size") - F.size("vs")), F.lit(0)).cast("int")
        entries = self._written("entries", held.select("rep", F.explode(F.slice("vs.v", 1, left)).alias("v")))
        heads = entries.groupBy("v").agg(F.count(F.lit(1)).alias("m"), F.min("rep").alias("pivot")).where("m > 1")
        self.entries = self._written("lists", entries.join(heads, "v"))
        active = self.entries.select(F.col("rep").alias("id")).distinct()
        own = self.reps.select(F.col("rep").alias("id"), "k1", "k2").join(active, "id", "left_semi")
        texts = self.docs.join(active, F.col(self.id_col) == F.col("id"), "left_semi")
        full = shingle_sets(texts, self.id_col, self.text_col, self.width)
        # of rows that share an id, only those with the representative's set
        self.full = self._written("sets", full.join(own, "id").where((F.xxhash64("set") == F.col("k1")) & (F.xxhash64(F.lit(1), "set") == F.col("k2")))
                                  .select(F.col("id").alias("rep"), "set"))

    def verified(self, name: str, pairs: DataFrame) -> DataFrame:
        """Of distinct pairs (a, b) those that are linked: first by union-sketch estimate, then on the full sets."""
        sketch = self.reps.select("rep", "sketch")
        p = (pairs.distinct().join(sketch.withColumnsRenamed({"rep": "a", "sketch": "sa"}), "a")
             .join(sketch.withColumnsRenamed({"rep": "b", "sketch": "sb"}), "b"))
        union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, self.k)
        both = F.size(F.array_intersect(F.array_intersect("sa", "sb"), F.col("u")))
        near = p.withColumn("u", union).where(both >= F.size("u") * self.share).select("a", "b")
        full = self.full
        inter = F.size(F.array_intersect("xa", "xb"))
        linked = (near.join(full.withColumnsRenamed({"rep": "a", "set": "xa"}), "a").join(full.withColumnsRenamed({"rep": "b", "set": "xb"}), "b")
                  .select("a", "b", inter.alias("i"), F.size("xa").alias("na"), F.size("xb").alias("nb"))
                  .where(_linked(F.col("i"), F.col("na"), F.col("nb"), self.percent)).select("a", "b"))
        return self._written(name, linked)

    def links(self) -> DataFrame:
        lists = self.entries
        first = self.verified("links_pivot", lists.where("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")))
        labels = components(first, f"{self.folder}/cc1").withColumnRenamed("node", "rep")
        marked = (lists.where("m > 2").join(labels, "rep", "left")
                  .select("v", "rep", "m", "pivot", F.coalesce("label", "rep").alias("comp")))
        split = marked.groupBy("v").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("v")
        rest = self._written("unresolved", marked.join(split, "v"))
        few = rest.where((F.col("m") <= self.small) & (F.col("rep") != F.col("pivot")))
        other = few.select("v", F.col("rep").alias("b"), F.col("comp").alias("comp_b"))
        pairs = (few.select("v", F.col("rep").alias("a"), "comp").join(other, "v")
                 .where("a < b and comp <> comp_b").select("a", "b"))
        second = self.verified("links_lists", pairs)
        return first.unionByName(second).unionByName(self.long_lists(rest.where(F.col("m") > self.small)))

    def long_lists(self, rest: DataFrame) -> DataFrame:
        groups = components(rest.where("rep <> pivot").select(F.col("rep").alias("a"), F.col("pivot").alias("b")), f"{self.folder}/cc2")
        member = (rest.select("rep", "comp").distinct().join(groups.select(F.col("node").alias("rep"), F.col("label").alias("grp")), "rep"))
        member = self._written("long", member)
        sizes = member.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / self.block).cast("int").alias("blocks"))
        cut = (member.join(sizes, "grp").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
               .select("rep", "comp", "grp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")))
        keyed = cut.select("rep", "comp", "grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        return self._written("links_long", keyed.join(self.full.dropDuplicates(["rep"]), "rep").groupBy("grp", "i", "j")
                             .applyInPandas(_block_links(self.percent), f"a {self.id_type}, b {self.id_type}"))

    def result(self) -> DataFrame:
        self.classes()
        self.lists()
        labels = components(self.links(), f"{self.folder}/cc3").withColumnRenamed("node", "rep")
        of = (self.reps.select("k1", "k2", "rep").join(labels, "rep", "left")
              .select("k1", "k2", F.coalesce("label", "rep").alias("component")))
        lone = (F.col("n") == 0) | F.col("id").isNull()
        return (self.members.select("id", "n", "k1", "k2").join(of, ["k1", "k2"], "left")
                .select(F.col("id").alias(self.name), F.col("n").cast("long").alias("n_shingles"),
                        F.when(lone, F.col("id")).otherwise(F.col("component")).alias("component_id"))
                .withColumn("kept", F.col(self.name).eqNullSafe(F.col("component_id"))))


def least_share(percent: int, k: int, miss: float) -> float:
    """Share of the union sketch that linked sets have in common but for a probability of at most ``miss``: the largest count c of
    k values with P(Binomial(k, percent / 100) < c) <= miss, as the share that rounds up to c.  0 for ``miss`` = 0."""
    s, tail = percent / 100, 0.0
    for c in range(k + 1):
        tail += math.comb(k, c) * s ** c * (1 - s) ** (k - c)  # P(X <= c)
        if tail > miss:
            return max(0.0, (c - 1 + 1e-6) / k) if c else 0.0
    return min(s, (k - 1 + 1e-6) / k)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 85, k: int = 64,
               miss: float = 1e-6, small: int = 64, block: int = 512) -> DataFrame:
    """One row per document: (id, n_shingles, component_id, kept).

    ``miss`` bounds the probability with which a link at the limit is lost in a sketch; the share of the sketch that is indexed and
    compared follows from it, ``percent`` and ``k``.  With 0 every pair that meets in any sketch value is verified on the full sets.
    """
    return NearDuplicates(docs, id_col, text_col, width, percent, k, least_share(percent, k, miss), small, block).result()


ORACLE = r"""WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM i JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.a, r.c FROM r JOIN e ON e.b = r.doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(c) AS component_id FROM r GROUP BY 1) LEFT JOIN n USING (doc_id)"""
