"""Recall-stage metric queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import cf, retrieval
from tessera.plans import sqlparts as Q
from tessera.plans import standins as S
from tessera.plans.catalog import query

KS = (1, 2, 4, 8)


def _i2i(spark, sf_dir):
    """Event item CF read back through the A4 item-to-item reader."""
    from tessera.sources import read_i2i
    b = S.behaviour(spark, sf_dir)
    return read_i2i(spark, cf.item_cf(b, "user", "item", "relevance", top=10), "item1", "item2", "sim")


_I2I_SQL = f"""{Q.BEHAVIOUR},
ev AS (SELECT "user", item, relevance AS rating FROM beh), {Q.item_cf('ev')},
lists AS (SELECT item1, item2, row_number() OVER (PARTITION BY item1
                 ORDER BY (sim * 524289::DOUBLE - (sim * 524289::DOUBLE - sim)) DESC, item2) AS pos FROM cf_top),
lens AS (SELECT item1, count(*) AS n_recs FROM lists GROUP BY 1),
nxt AS (SELECT "user", item, lead(item) OVER w AS truth, lead(relevance) OVER w AS trel
        FROM beh WINDOW w AS (PARTITION BY "user" ORDER BY ts, item)),
lab AS (SELECT n."user", n.item, n.truth, n.trel, l.pos, coalesce(m.n_recs, 0) AS n_recs
        FROM nxt n LEFT JOIN lists l ON l.item1 = n.item AND l.item2 = n.truth
                   LEFT JOIN lens m ON m.item1 = n.item
        WHERE n.truth IS NOT NULL)"""


@query("rec_lists", f"""WITH {_I2I_SQL}
SELECT item1, item2, cast(pos AS bigint) AS pos FROM lists""")
def q_rec_lists(spark, sf_dir):
    """list positions of an event-based item CF table."""
    return retrieval.rec_lists(_i2i(spark, sf_dir)).select(
        "item1", "item2", F.col("pos").cast("bigint"))


@query("next_item_truth", f"""WITH {Q.BEHAVIOUR},
nxt AS (SELECT "user", item, lead(item) OVER w AS truth, lead(relevance) OVER w AS trel,
               ts FROM beh WINDOW w AS (PARTITION BY "user" ORDER BY ts, item))
SELECT "user", item, truth, trel AS truth_relevance, ts AS "timestamp" FROM nxt
WHERE truth IS NOT NULL""")
def q_next_item_truth(spark, sf_dir):
    """F2 (with A4 casts): next-event truth per user event."""
    t = retrieval.next_item_truth(S.behaviour(spark, sf_dir))
    return t.select("user", "item", "truth", "truth_relevance", "timestamp")


@query("label_predictions", f"""WITH {_I2I_SQL}
SELECT "user", item, truth, cast(pos AS bigint) AS pos, cast(n_recs AS bigint) AS n_recs FROM lab""")
def q_label_predictions(spark, sf_dir):
    """left join of next-item pairs with list positions and lengths."""
    lab = retrieval.label_predictions(S.behaviour(spark, sf_dir), _i2i(spark, sf_dir))
    return lab.select("user", "item", "truth", F.col("pos").cast("bigint"),
                      F.col("n_recs").cast("bigint"))


@query("retrieval_metrics", f"""WITH {_I2I_SQL},
ks AS (SELECT unnest([1, 2, 4, 8]) AS k),
h AS (SELECT k, CASE WHEN pos <= k THEN 1 ELSE 0 END AS tp, least(k, n_recs) AS tpfp,
             CASE WHEN pos <= k THEN 1.0 / pos ELSE 0.0 END AS mrr,
             CASE WHEN pos <= k AND trel <> 0 THEN 1.0 / log2(pos + 1.0) ELSE 0.0 END AS ndcg
      FROM lab CROSS JOIN ks),
t AS (SELECT k, cast(sum(tp) AS double) AS tp, cast(sum(tpfp) AS double) AS tpfp,
             count(*) AS n, sum(mrr) AS mrr, sum(ndcg) AS ndcg FROM h GROUP BY k),
pr AS (SELECT *, CASE WHEN tpfp > 0 THEN tp / tpfp ELSE 0.0 END AS p, tp / n AS r FROM t)
SELECT cast(k AS bigint) AS k, round(p, 6) AS precision, round(r, 6) AS recall,
       round(2 * p * r / (p + r + 1e-8), 6) AS f1, round(mrr / n, 6) AS mrr,
       round(ndcg / n, 6) AS ndcg, n AS n_pairs FROM pr""")
def q_retrieval_metrics(spark, sf_dir):
    """Precision, recall, F1, MRR, NDCG at 1, 2, 4, 8 of event item CF."""
    m = retrieval.retrieval_metrics(S.behaviour(spark, sf_dir), _i2i(spark, sf_dir), KS)
    return m.select(F.col("k").cast("bigint").alias("k"),
                    *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1", "mrr", "ndcg")],
                    F.col("n_pairs").cast("bigint"))
