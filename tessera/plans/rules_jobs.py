"""Association-rule queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import itemsets, rules
from tessera.plans import sqlparts as Q
from tessera.plans import standins as S
from tessera.plans.catalog import query
from tessera.sources import read_transactions


def _tx(spark, sf_dir):
    return read_transactions(S.transactions(spark, sf_dir), "items")


@query("read_transactions", f"""WITH {Q.TRANSACTIONS}
SELECT cast(tid AS bigint) AS tid, count(*) AS n_items FROM tx GROUP BY tid""")
def q_read_transactions(spark, sf_dir):
    """A2: split baskets into arrays of distinct items."""
    t = _tx(spark, sf_dir)
    return t.select(F.col("tid").cast("bigint").alias("tid"), F.size("items").cast("bigint").alias("n_items"))


@query("frequent_pairs", f"""WITH {Q.TRANSACTIONS},
p AS (SELECT a.item AS x, b.item AS y, count(*) AS freq FROM tx a JOIN tx b
      ON a.tid = b.tid AND a.item < b.item GROUP BY 1, 2 HAVING count(*) >= 3),
s AS (SELECT item AS x, NULL AS y, count(*) AS freq FROM tx GROUP BY item HAVING count(*) >= 3)
SELECT x AS item_a, y AS item_b, freq FROM p UNION ALL SELECT x, y, freq FROM s""")
def q_frequent_pairs(spark, sf_dir):
    """FP-growth frequent itemsets of size 1 and 2 at min count 3."""
    fi = rules.frequent_itemsets(_tx(spark, sf_dir), "items", min_count=3)
    fi = fi.filter(F.size("items") <= 2).select(F.array_sort("items").alias("items"), "freq")
    return fi.select(F.col("items")[0].alias("item_a"),
                     F.when(F.size("items") == 2, F.col("items")[1]).alias("item_b"),
                     F.col("freq").cast("bigint").alias("freq"))


_RULES_SQL = f"""WITH {Q.TRANSACTIONS}, {Q.pair_rules()}
SELECT antecedent, consequent, round(lift, 6) AS lift FROM rules_top"""


@query("fp_rules", _RULES_SQL)
def q_fp_rules(spark, sf_dir):
    """FP-growth one-to-one rules, top 10 by lift, over order baskets."""
    r = rules.fp_rules(_tx(spark, sf_dir), "items", min_count=3, min_confidence=0.1, top=10)
    return r.select("antecedent", "consequent", F.round("lift", 6).alias("lift"))


@query("pair_rules", _RULES_SQL)
def q_pair_rules(spark, sf_dir):
    """C4 second plan: rules from pair support counts (skew-split pair join)."""
    r = rules.pair_rules(_tx(spark, sf_dir), "items", 3, 0.1, 10, tid="tid")
    return r.select("antecedent", "consequent", F.round("lift", 6).alias("lift"))


_EV_RULES_SQL = f"""WITH {Q.USER_DAY_TRANSACTIONS}, {Q.pair_rules()}
SELECT antecedent, consequent, round(lift, 6) AS lift FROM rules_top"""


@query("fp_rules_events", _EV_RULES_SQL)
def q_fp_rules_events(spark, sf_dir):
    """C5 over user-day event baskets (denser co-occurrence)."""
    t = read_transactions(S.user_day_transactions(spark, sf_dir), "items")
    r = rules.fp_rules(t, "items", min_count=3, min_confidence=0.1, top=10)
    return r.select("antecedent", "consequent", F.round("lift", 6).alias("lift"))


@query("pair_rules_events", _EV_RULES_SQL)
def q_pair_rules_events(spark, sf_dir):
    """C4 second plan over user-day event baskets."""
    t = read_transactions(S.user_day_transactions(spark, sf_dir), "items")
    r = rules.pair_rules(t, "items", 3, 0.1, 10, tid="tid", block_size=4)
    return r.select("antecedent", "consequent", F.round("lift", 6).alias("lift"))


_BRANDS_SQL = """tx AS (SELECT DISTINCT l_orderkey AS tid, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey),
s1 AS (SELECT item AS a, count(*) AS freq FROM tx GROUP BY 1 HAVING count(*) >= 3),
s2 AS (SELECT x.item AS a, y.item AS b, count(*) AS freq FROM tx x JOIN tx y ON x.tid = y.tid AND x.item < y.item
       GROUP BY 1, 2 HAVING count(*) >= 3),
s3 AS (SELECT x.item AS a, y.item AS b, z.item AS c, count(*) AS freq
       FROM tx x JOIN tx y ON x.tid = y.tid AND x.item < y.item JOIN tx z ON z.tid = x.tid AND y.item < z.item
       GROUP BY 1, 2, 3 HAVING count(*) >= 3)"""


@query("itemsets_size_3", f"""WITH {_BRANDS_SQL}
SELECT a AS items, freq FROM s1 UNION ALL SELECT a || ',' || b, freq FROM s2 UNION ALL SELECT a || ',' || b || ',' || c, freq FROM s3""")
def q_itemsets(spark, sf_dir):
    """Frequent sets of up to three brands in an order, level by level."""
    found = itemsets.level_itemsets(S.brand_baskets(spark, sf_dir), "tid", "items", min_count=3, max_size=3, block_size=4)
    return found.select(F.array_join("items", ",").alias("items"), "freq")


@query("rules_two_antecedents", f"""WITH {_BRANDS_SQL},
n AS (SELECT count(DISTINCT tid) AS n FROM tx),
r AS (SELECT a || ',' || b AS antecedent, c AS consequent, freq, a AS x, b AS y FROM s3
      UNION ALL SELECT a || ',' || c, b, freq, a, c FROM s3 UNION ALL SELECT b || ',' || c, a, freq, b, c FROM s3)
SELECT r.antecedent, r.consequent, round(r.freq / s2.freq, 6) AS confidence, round(r.freq / s2.freq / (s1.freq / n.n), 6) AS lift,
       round(r.freq / n.n, 6) AS support
FROM r JOIN s2 ON s2.a = r.x AND s2.b = r.y JOIN s1 ON s1.a = r.consequent, n WHERE r.freq / s2.freq >= 0.02""")
def q_rules_two(spark, sf_dir):
    """Rules from two brands to a third."""
    baskets = S.brand_baskets(spark, sf_dir)
    found = itemsets.level_itemsets(baskets, "tid", "items", min_count=3, max_size=3)
    rules3 = itemsets.itemset_rules(found, baskets.count(), 0.02).where(F.size("antecedent") == 2)
    return rules3.select(F.array_join("antecedent", ",").alias("antecedent"), "consequent",
                         *[F.round(c, 6).alias(c) for c in ("confidence", "lift", "support")])
