"""List-wise ranking metric queries (G1-G13) over order lines as lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import ranking as R
from tessera.plans import sqlparts as Q
from tessera.plans import standins as S
from tessera.plans.catalog import query

BIN = "CASE WHEN label >= 1 THEN 1.0 ELSE 0.0 END"
GAIN = "(pow(2.0, label) - 1.0)"
DISC = "(0.6931471805599453 / ln(1.0 + pos))"


def _prep(spark, sf_dir):
    return R.prepare_lists(S.ranking_lists(spark, sf_dir))


def _out(df, metric):
    return df.select("list_id", F.round(metric, 6).alias(metric), F.round("weight", 6).alias("weight"))


def _sql(body, metric, wname=None):
    w = f"JOIN {wname} USING (list_id)" if wname else ""
    return f"""{body}
SELECT list_id, round(m.{metric}, 6) AS {metric}, round({'m.' if not wname else wname + '.'}weight, 6) AS weight
FROM m {w}"""


@query("rank_prepare", f"""WITH {Q.LISTS}
SELECT list_id, item_id, label, score, cast(pos AS bigint) AS pos FROM rk""")
def q_prepare(spark, sf_dir):
    """G1 + H2: cleaned labels/scores and 1-based rank by score."""
    r = R.rank_lists(_prep(spark, sf_dir))
    return r.select("list_id", "item_id", "label", "score", F.col("pos").cast("bigint"))


@query("rank_list_weights", f"""WITH {Q.LISTS}, {Q.list_weights('lw', BIN)}
SELECT list_id, round(weight, 6) AS weight FROM lw""")
def q_weights(spark, sf_dir):
    """Per-list weights with binary relevance."""
    w = R.list_weights(_prep(spark, sf_dir), F.when(F.col("label") >= 1, 1.0).otherwise(0.0))
    return w.select("list_id", F.round("weight", 6).alias("weight"))


@query("rank_mrr", _sql(f"""WITH {Q.LISTS}, {Q.list_weights('lw', BIN)},
m AS (SELECT list_id, max(CASE WHEN label >= 1 THEN 1.0 / pos ELSE 0.0 END) AS mrr
      FROM rk GROUP BY 1)""", "mrr", "lw"))
def q_mrr(spark, sf_dir):
    """MRR over whole lists."""
    return _out(R.mrr(_prep(spark, sf_dir)), "mrr")


@query("rank_arp", f"""WITH {Q.LISTS},
m AS (SELECT list_id, sum(label * weight) AS weight,
             CASE WHEN sum(label * weight) <> 0 THEN sum(pos * label * weight) / sum(label * weight)
                  ELSE 0.0 END AS arp FROM rk GROUP BY 1)
SELECT list_id, round(arp, 6) AS arp, round(weight, 6) AS weight FROM m""")
def q_arp(spark, sf_dir):
    """Average relevance position."""
    return _out(R.arp(_prep(spark, sf_dir)), "arp")


@query("rank_precision_at_4", _sql(f"""WITH {Q.LISTS}, {Q.list_weights('lw', BIN)},
m AS (SELECT list_id, avg({BIN}) AS precision FROM rk WHERE pos <= 4 GROUP BY 1)""",
                                    "precision", "lw"))
def q_precision(spark, sf_dir):
    """Precision at 4 (divisor = rows kept)."""
    return _out(R.precision_at(_prep(spark, sf_dir), 4), "precision")


@query("rank_map", _sql(f"""WITH {Q.LISTS}, {Q.list_weights('lw', BIN)},
c AS (SELECT *, {BIN} AS rel, sum({BIN}) OVER (PARTITION BY list_id ORDER BY pos
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_rel FROM rk),
m AS (SELECT list_id, CASE WHEN sum(weight * rel) <> 0
                      THEN sum(cum_rel / pos * weight * rel) / sum(weight * rel) ELSE 0.0 END AS map
      FROM c GROUP BY 1)""", "map", "lw"))
def q_map(spark, sf_dir):
    """Mean average precision over whole lists."""
    return _out(R.mean_average_precision(_prep(spark, sf_dir)), "map")


def _ndcg_sql(n):
    cut = f"WHERE pos <= {n}" if n else ""
    icut = f"WHERE ipos <= {n}" if n else ""
    return _sql(f"""WITH {Q.LISTS}, {Q.list_weights('lw', GAIN)},
d AS (SELECT list_id, sum(weight * {GAIN} * {DISC}) AS dcg FROM rk {cut} GROUP BY 1),
ir AS (SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY weight * label DESC, item_id)
              AS ipos FROM prep),
i AS (SELECT list_id, sum(weight * {GAIN} * {DISC.replace('pos', 'ipos')}) AS idcg
      FROM ir {icut} GROUP BY 1),
m AS (SELECT list_id, CASE WHEN idcg <> 0 THEN dcg / idcg ELSE 0.0 END AS ndcg
      FROM d JOIN i USING (list_id))""", "ndcg", "lw")


@query("rank_ndcg_at_4", _ndcg_sql(4))
def q_ndcg4(spark, sf_dir):
    """NDCG at 4."""
    return _out(R.ndcg(_prep(spark, sf_dir), 4), "ndcg")


@query("rank_ndcg", _ndcg_sql(None))
def q_ndcg(spark, sf_dir):
    """NDCG over whole lists."""
    return _out(R.ndcg(_prep(spark, sf_dir)), "ndcg")


@query("rank_dcg_at_2", f"""WITH {Q.LISTS}, {Q.list_weights('lw', GAIN)},
d AS (SELECT list_id, sum(weight * {GAIN} * {DISC}) AS dcg FROM rk WHERE pos <= 2 GROUP BY 1),
m AS (SELECT list_id, CASE WHEN lw.weight <> 0 THEN dcg / lw.weight ELSE 0.0 END AS dcg, lw.weight
      FROM d JOIN lw USING (list_id))
SELECT list_id, round(dcg, 6) AS dcg, round(weight, 6) AS weight FROM m""")
def q_dcg(spark, sf_dir):
    """DCG at 2 divided by the list weight."""
    return _out(R.dcg(_prep(spark, sf_dir), 2), "dcg")


@query("rank_opa", f"""WITH {Q.LISTS},
pr AS (SELECT a.list_id, sum(CASE WHEN a.score > b.score THEN a.weight ELSE 0.0 END) AS c,
              sum(a.weight) AS w
       FROM prep a JOIN prep b ON a.list_id = b.list_id AND a.label > b.label
       WHERE a.valid AND b.valid GROUP BY 1),
l AS (SELECT DISTINCT list_id FROM prep WHERE valid),
m AS (SELECT l.list_id, CAST(coalesce(w, 0.0) AS DOUBLE) AS weight,
             CASE WHEN coalesce(w, 0.0) <> 0 THEN c / w ELSE 0.0 END AS opa
      FROM l LEFT JOIN pr USING (list_id))
SELECT list_id, round(opa, 6) AS opa, round(weight, 6) AS weight FROM m""")
def q_opa(spark, sf_dir):
    """Ordered pair accuracy (grade scans, no pair join)."""
    return _out(R.opa(_prep(spark, sf_dir)), "opa")


def _div(spark, sf_dir):
    li = S.ranking_lists(spark, sf_dir)
    d = li.select("list_id", "item_id", "subtopic",
                  F.when(F.col("quantity") >= 25, 1.0).when(F.col("quantity") < 5, -1.0).otherwise(0.0).alias("label"),
                  "score", "weight")
    return R.prepare_diversity(d)


@query("diversity_prepare", f"""WITH {Q.DIVERSITY}
SELECT list_id, item_id, score, valid, any_rel FROM ditems""")
def q_div_prepare(spark, sf_dir):
    """Item validity, adjusted scores and any-relevance flags."""
    items, _ = _div(spark, sf_dir)
    return items.select("list_id", "item_id", "score", "valid", "any_rel")


@query("diversity_precision_ia_at_3", f"""WITH {Q.DIVERSITY}, {Q.list_weights('lw', 'any_rel', 'ditems')},
kept AS (SELECT list_id, count(*) AS k FROM drk WHERE pos <= 3 GROUP BY 1),
hits AS (SELECT c.list_id, count(*) AS h FROM dcells c JOIN drk r USING (list_id, item_id)
         WHERE r.pos <= 3 AND c.label >= 1 GROUP BY 1),
tp AS (SELECT list_id, count(DISTINCT subtopic) AS t FROM dcells WHERE label >= 1 GROUP BY 1),
m AS (SELECT kept.list_id, CASE WHEN k * coalesce(t, 0) <> 0 THEN coalesce(h, 0) / (k * t)
                                ELSE 0.0 END AS precision_ia
      FROM kept LEFT JOIN hits USING (list_id) LEFT JOIN tp USING (list_id))
SELECT list_id, round(m.precision_ia, 6) AS precision_ia, round(lw.weight, 6) AS weight
FROM m JOIN lw USING (list_id)""")
def q_pre_ia(spark, sf_dir):
    """Intent-aware precision at 3 (subtopic = return flag)."""
    items, cells = _div(spark, sf_dir)
    return _out(R.precision_ia(items, cells, 3), "precision_ia")


@query("diversity_alpha_dcg", f"""WITH {Q.DIVERSITY}, {Q.list_weights('lw', 'any_rel', 'ditems')},
c AS (SELECT c.*, r.pos, r.weight,
             sum(c.label) OVER (PARTITION BY c.list_id, c.subtopic ORDER BY r.pos
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
      FROM dcells c JOIN drk r USING (list_id, item_id)),
g AS (SELECT list_id, item_id, pos, weight, sum(label * pow(0.5, coalesce(earlier, 0.0))) AS gain
      FROM c GROUP BY 1, 2, 3, 4),
d AS (SELECT list_id, sum(weight * gain * {DISC}) AS adcg FROM g GROUP BY 1),
m AS (SELECT list_id, CASE WHEN lw.weight <> 0 THEN adcg / lw.weight ELSE 0.0 END AS alpha_dcg,
             lw.weight FROM d JOIN lw USING (list_id))
SELECT list_id, round(alpha_dcg, 6) AS alpha_dcg, round(weight, 6) AS weight FROM m""")
def q_alpha_dcg(spark, sf_dir):
    """Alpha-DCG (alpha 0.5) over whole lists."""
    items, cells = _div(spark, sf_dir)
    return _out(R.alpha_dcg(items, cells, None, 0.5), "alpha_dcg")


_REPORT_NS = (1, 4, 8, 20, None)


def _report_sql():
    ns = _REPORT_NS
    name = lambda n: "ndcg_all" if n is None else f"ndcg_{n}"
    cut = lambda c, n: "TRUE" if n is None else f"{c} <= {n}"
    d = ",\n       ".join(f"sum(CASE WHEN {cut('pos', n)} THEN weight * {GAIN} * {DISC} ELSE 0.0 END) AS d_{k}"
                          for k, n in enumerate(ns))
    idisc = DISC.replace("pos", "ipos")
    i = ",\n       ".join(f"sum(CASE WHEN {cut('ipos', n)} THEN weight * {GAIN} * {idisc} ELSE 0.0 END) AS i_{k}"
                          for k, n in enumerate(ns))
    per = ", ".join(f"CASE WHEN i_{k} <> 0 THEN d_{k} / i_{k} ELSE 0.0 END AS {name(n)}" for k, n in enumerate(ns))
    agg = ", ".join(f"round(CASE WHEN sum(weight) <> 0 THEN sum({name(n)} * weight) / sum(weight) ELSE 0.0 END, 6) "
                    f"AS {name(n)}" for n in ns)
    return f"""WITH {Q.LISTS}, {Q.list_weights('lw', GAIN)},
d AS (SELECT list_id, {d} FROM rk GROUP BY 1),
ir AS (SELECT *, row_number() OVER (PARTITION BY list_id ORDER BY weight * label DESC, item_id) AS ipos FROM prep),
i AS (SELECT list_id, {i} FROM ir GROUP BY 1),
per AS (SELECT lw.weight, {per} FROM d JOIN i USING (list_id) JOIN lw USING (list_id))
SELECT {agg} FROM per"""


@query("ndcg_report", _report_sql())
def q_ndcg_report(spark, sf_dir):
    """G8 evaluation at cut-offs 1, 4, 8, 20 and all: weighted means in one row."""
    r = R.ndcg_report(_prep(spark, sf_dir), _REPORT_NS)
    return r.select(*[F.round(c, 6).alias(c) for c in r.columns])
