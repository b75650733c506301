"""Prediction evaluation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluate as J
from tessera.plans import standins as S
from tessera.plans.catalog import query


def _predictions(spark, sf_dir):
    """(doc_id, label, logit, prediction): quality labels scored by a logistic
    of the log document length."""
    lb = S.table(spark, sf_dir, "labels").select("doc_id", "quality")
    d = S.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    z = F.log(F.greatest(F.col("n_chars"), F.lit(1)).cast("double")) - F.lit(7.5)
    return lb.join(d, "doc_id").select("doc_id", F.col("quality").cast("double").alias("label"),
                                       z.alias("logit"), J.sigmoid(z).alias("prediction"))


_PRED_SQL = """pr AS (
  SELECT l.doc_id, cast(l.quality AS double) AS label,
         ln(cast(greatest(d.n_chars, 1) AS double)) - 7.5 AS logit
  FROM labels l JOIN documents d USING (doc_id)),
pp AS (SELECT *, 1.0 / (1.0 + exp(-logit)) AS prediction FROM pr)"""


def _auc_binned_sql(n):
    return f"""WITH {_PRED_SQL},
b AS (SELECT label, prediction AS p, floor(prediction * {n - 1}) AS m FROM pp),
k AS (SELECT label, CASE WHEN p > -1e-7 THEN 1 ELSE 0 END
                    + least(greatest(CASE WHEN m / {float(n - 1)} < p THEN m ELSE m - 1 END, 0), {n - 2})
                    + CASE WHEN p > 1 + 1e-7 THEN 1 ELSE 0 END AS k FROM b),
h AS (SELECT k, sum(label) AS pos, sum(1.0 - label) AS neg FROM k GROUP BY k),
bins AS (SELECT range AS k FROM range(0, {n + 1})),
hh AS (SELECT bins.k, coalesce(pos, 0.0) AS pos, coalesce(neg, 0.0) AS neg
       FROM bins LEFT JOIN h USING (k)),
c AS (SELECT k AS i, sum(pos) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fn,
             sum(neg) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tn,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM hh),
r AS (SELECT i, (P - fn + 1e-6) / (P - fn + fn + 1e-6) AS y, (N - tn) / (N - tn + tn + 1e-6) AS x
      FROM c WHERE i < {n}),
s AS (SELECT x, y, lead(x) OVER (ORDER BY i) AS x2, lead(y) OVER (ORDER BY i) AS y2 FROM r)
SELECT round(sum(coalesce((x - x2) * (y + y2) / 2.0, 0.0)), 6) AS auc FROM s"""


@query("auc_binned_500", _auc_binned_sql(500))
def q_auc500(spark, sf_dir):
    """ROC AUC with 500 thresholds."""
    return J.auc_binned(_predictions(spark, sf_dir), 500).select(F.round("auc", 6).alias("auc"))


@query("auc_binned_1000", _auc_binned_sql(1000))
def q_auc1000(spark, sf_dir):
    """ROC AUC with 1000 thresholds."""
    return J.auc_binned(_predictions(spark, sf_dir), 1000).select(F.round("auc", 6).alias("auc"))


@query("auc_exact", f"""WITH {_PRED_SQL},
a AS (SELECT sum(CASE WHEN p.prediction > n.prediction THEN 1.0
                      WHEN p.prediction = n.prediction THEN 0.5 ELSE 0.0 END) AS u
      FROM pp p JOIN pp n ON p.label = 1 AND n.label = 0),
c AS (SELECT sum(label) AS P, sum(1 - label) AS N FROM pp)
SELECT round(u / (P * N), 6) AS auc FROM a, c""")
def q_auc_exact(spark, sf_dir):
    """Exact ROC AUC (ties one half) by a distinct-score running sum."""
    return J.auc_exact(_predictions(spark, sf_dir)).select(F.round("auc", 6).alias("auc"))


@query("log_loss", f"""WITH {_PRED_SQL}
SELECT round(avg(greatest(logit, 0.0) - logit * label + ln(1 + exp(-abs(logit)))), 6) AS log_loss,
       round(avg(1.0 / (1.0 + exp(-logit))), 6) AS mean_probability FROM pr""")
def q_log_loss(spark, sf_dir):
    """Mean sigmoid cross-entropy and mean probability."""
    r = J.log_loss(_predictions(spark, sf_dir))
    return r.select(F.round("log_loss", 6).alias("log_loss"),
                    F.round("mean_probability", 6).alias("mean_probability"))


_LIST_SQL = """ls AS (
  SELECT l_orderkey AS list_id,
         cast(l_partkey AS varchar) || ':' || cast(l_linenumber AS varchar) || ':'
           || cast(l_suppkey AS varchar) AS item_id,
         floor(l_quantity / 10) - 1 AS label, l_extendedprice / 10000.0 AS score FROM lineitem)"""


def _lists(spark, sf_dir):
    li = S.ranking_lists(spark, sf_dir)
    return li.select("list_id", "item_id", "label", (F.col("score") / 10000.0).alias("score"))


@query("list_softmax", f"""WITH {_LIST_SQL},
m AS (SELECT list_id, max(score) AS mx FROM ls GROUP BY 1),
e AS (SELECT ls.*, exp(score - mx) AS ex FROM ls JOIN m USING (list_id)),
s AS (SELECT list_id, sum(ex) AS se FROM e GROUP BY 1)
SELECT list_id, item_id, round(ex / se, 6) AS probability FROM e JOIN s USING (list_id)""")
def q_list_softmax(spark, sf_dir):
    """Per-list softmax of scores."""
    p = J.list_softmax(_lists(spark, sf_dir))
    return p.select("list_id", "item_id", F.round("probability", 6).alias("probability"))


@query("listwise_loss", f"""WITH {_LIST_SQL},
v AS (SELECT * FROM ls WHERE label >= 0),
m AS (SELECT list_id, max(label) AS my, max(score) AS mz FROM v GROUP BY 1),
x AS (SELECT v.list_id, v.label - my AS y, v.score - mz AS z FROM v JOIN m USING (list_id)),
t AS (SELECT list_id, sum(exp(y)) AS sy, sum(exp(z)) AS sz, sum(exp(y) * z) AS syz FROM x GROUP BY 1)
SELECT list_id, round(ln(sz) - syz / sy, 6) AS loss FROM t""")
def q_listwise_loss(spark, sf_dir):
    """Masked softmax cross-entropy per list."""
    l = J.listwise_loss(_lists(spark, sf_dir))
    return l.select("list_id", F.round("loss", 6).alias("loss"))


@query("ctr_baseline")
def q_ctr(spark, sf_dir):
    """Hashed-feature logistic regression fit on event samples, scored back.

    Rows-only check (an iterative fit); its AUC is tested against 0.5 on
    separable data in the unit tests."""
    from tessera.plans.samples_jobs import _event_samples
    smp = _event_samples(spark, sf_dir).withColumn("user_id", F.col("user").cast("string")) \
        .withColumn("age_bucket", F.coalesce(F.col("age"), F.lit(0)))
    model = J.ctr_fit(smp, ["user_id", "item", "gender"], ["age_bucket"], "label", 1024, 10)
    s = J.ctr_score(model, smp)
    return s.select("sample_id", F.round("prediction", 6).alias("prediction"))
