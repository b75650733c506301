"""List utility queries (H1-H5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.scan import hot_sums
from tessera.functions.stable import sql_stable_u01
from tessera.operators import lists as L
from tessera.plans import sqlparts as Q
from tessera.plans import standins as S
from tessera.plans.catalog import query

U_ITEM = sql_stable_u01("item_id")


def _lists(spark, sf_dir):
    li = S.ranking_lists(spark, sf_dir)
    return li.select("list_id", "item_id", "score", "label",
                     F.col("label").alias("position_label"),
                     (F.col("quantity") >= 10).alias("valid"),
                     F.split("item_id", ":")[1].cast("long").alias("position"))


_RAW = """raw AS (
  SELECT l_orderkey AS list_id,
         cast(l_partkey AS varchar) || ':' || cast(l_linenumber AS varchar) || ':'
           || cast(l_suppkey AS varchar) AS item_id,
         l_extendedprice AS score, l_quantity >= 10 AS valid, cast(l_linenumber AS bigint) AS position
  FROM lineitem)"""


@query("list_sort_top3", f"""WITH {_RAW},
r AS (SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY score DESC, item_id) AS pos FROM raw)
SELECT list_id, item_id, cast(pos AS bigint) AS pos FROM r WHERE pos <= 3""")
def q_sort_top3(spark, sf_dir):
    """H1: top 3 rows per list by score."""
    return L.sort_by_scores(_lists(spark, sf_dir), 3).select("list_id", "item_id", F.col("pos").cast("bigint"))


@query("list_sort_shuffled_ties", f"""WITH {_RAW},
t AS (SELECT list_id, item_id, round(score, -3) AS score FROM raw),
r AS (SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY score DESC, {U_ITEM}, item_id) AS pos
      FROM t)
SELECT list_id, item_id, cast(pos AS bigint) AS pos FROM r""")
def q_sort_shuffled(spark, sf_dir):
    """H1 with seeded tie shuffling, on prices rounded to thousands (many ties)."""
    x = _lists(spark, sf_dir).withColumn("score", F.round("score", -3))
    return L.sort_by_scores(x, None, shuffle_ties=True).select(
        "list_id", "item_id", F.col("pos").cast("bigint"))


@query("list_sorted_ranks", f"""WITH {_RAW},
r AS (SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY score DESC, item_id) AS rank FROM raw)
SELECT list_id, item_id, score, cast(rank AS bigint) AS rank FROM r""")
def q_sorted_ranks(spark, sf_dir):
    """H2: 1-based rank of every row's score in its list."""
    return L.sorted_ranks(_lists(spark, sf_dir)).select("list_id", "item_id", "score",
                                                        F.col("rank").cast("bigint"))


@query("list_organize_valid", f"""WITH {_RAW},
r AS (SELECT *, row_number() OVER (PARTITION BY list_id
                ORDER BY CASE WHEN valid THEN 0 ELSE 1 END, {U_ITEM}, item_id) - 1 AS new_pos FROM raw)
SELECT list_id, item_id, valid, cast(new_pos AS bigint) AS new_pos FROM r""")
def q_organize(spark, sf_dir):
    """H3: valid rows (quantity >= 10) first, shuffled by a seeded uniform."""
    o = L.organize_valid(_lists(spark, sf_dir), "valid", shuffle=True)
    return o.select("list_id", "item_id", "valid", F.col("new_pos").cast("bigint"))


@query("list_pad_circular", f"""WITH {_RAW},
o AS (SELECT *, row_number() OVER (PARTITION BY list_id
                ORDER BY CASE WHEN valid THEN 0 ELSE 1 END, position, item_id) - 1 AS new_pos FROM raw),
nv AS (SELECT list_id, sum(CASE WHEN valid THEN 1 ELSE 0 END) AS n FROM raw GROUP BY 1),
s AS (SELECT list_id, n, unnest(range(0, 8)) AS slot FROM nv)
SELECT s.list_id, cast(s.slot AS int) AS slot, o.item_id, s.slot < s.n AS mask
FROM s JOIN o ON o.list_id = s.list_id AND o.new_pos = s.slot % greatest(s.n, 1)""")
def q_pad(spark, sf_dir):
    """H4: every list padded to 8 slots by repeating its valid rows."""
    p = L.pad_circular(_lists(spark, sf_dir), 8)
    return p.select("list_id", "slot", "item_id", "mask")


@query("de_noise", f"""WITH {Q.WORDS},
c AS (SELECT doc_id AS list_id, word AS key, count(*) AS cnt, any_value(lang) AS lang FROM words GROUP BY 1, 2),
lw AS (SELECT lang, word AS key, count(*) AS nz FROM words GROUP BY 1, 2),
j AS (SELECT c.list_id, c.key, cast(c.cnt AS double) AS c, cast(lw.nz AS double) AS nz
      FROM c JOIN lw ON lw.lang = c.lang AND lw.key = c.key),
t AS (SELECT list_id, sum(nz) AS ns, sum(c) AS cs FROM j GROUP BY 1),
x AS (SELECT j.list_id, j.key, j.c, j.nz / t.ns AS n FROM j JOIN t USING (list_id) WHERE t.cs > 0),
s AS (SELECT *, sum(n) OVER w AS cum_n, sum(c) OVER w AS cum_c FROM x
      WINDOW w AS (PARTITION BY list_id ORDER BY c / n DESC, key
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
k AS (SELECT *, c > 0 AND (0.11111111111111108 + cum_n) * c > n * cum_c AS is_pos FROM s),
lam AS (SELECT list_id, sum(CASE WHEN is_pos THEN c ELSE 0.0 END)
               / (1.0 + sum(CASE WHEN is_pos THEN n ELSE 0.0 END) / 0.11111111111111108) AS lam
        FROM k GROUP BY 1)
SELECT list_id AS doc_id, key AS word,
       round(CASE WHEN is_pos THEN c / lam - n / 0.11111111111111108 ELSE 0.0 END, 6) AS value
FROM k JOIN lam USING (list_id)""")
def q_de_noise(spark, sf_dir):
    """H5: de-noised word distribution per document against its language's counts."""
    # a document has at most one word for every two characters: lists that may be too long for one task, without tokenising
    chars = S.table(spark, sf_dir, "documents").select("doc_id", F.ceil((F.length(F.lower("text")) + 1) / 2).alias("n"))
    hot = hot_sums(chars, ["doc_id"], "n")
    # tokenised once: both counts read the same exchange
    dw = (S.document_words(spark, sf_dir).repartition("doc_id")
          .select("doc_id", "lang", F.explode("words").alias("word")))
    counts = dw.groupBy(F.col("doc_id").alias("list_id"), F.col("word").alias("key")).agg(
        F.count(F.lit(1)).alias("count"), F.first("lang").alias("lang"))
    per_lang = dw.groupBy("lang", F.col("word").alias("key")).agg(F.count(F.lit(1)).alias("nz"))
    # null-safe, without null languages: an equality would filter one side before that exchange and make it another
    same = counts["lang"].eqNullSafe(per_lang["lang"]) & (counts["key"] == per_lang["key"])
    both = counts.filter(F.col("lang").isNotNull()).join(per_lang, same).select(
        "list_id", counts["key"], "count", F.col("nz").alias("noise"))
    out = L.de_noise(both, None, ratio=0.9, hot=None if hot is None else "find")
    return out.select(F.col("list_id").alias("doc_id"), F.col("key").alias("word"),
                      F.round("value", 6).alias("value"))
