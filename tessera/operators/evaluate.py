"""Prediction evaluation and a CTR baseline.

Input ``(label in {0,1}, prediction in [0,1])`` or logits.  AUCs are
histogram aggregates (thresholds) or per-distinct-score aggregates with a
range-partitioned running sum (exact); losses are single aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scan import ordered_scan

# Fixed values of the thresholded AUC: 1e-6 is added to recall's numerator and
# denominator and to the false-positive rate's denominator; the end thresholds
# are -1e-7 and 1 + 1e-7.
AUC_EPSILON = 1e-6
THRESHOLD_EPSILON = 1e-7


def auc_binned(df: DataFrame, num_thresholds: int = 200, label: str = "label",
               prediction: str = "prediction") -> DataFrame:
    """ROC AUC by ``num_thresholds`` thresholds and trapezoids.

    Thresholds are ``-eps, 1/(n-1), ..., (n-2)/(n-1), 1+eps``; a prediction
    counts as positive at a threshold it is strictly above.  Each example is
    binned by how many thresholds it exceeds, so the data is one histogram
    aggregate of at most ``n + 1`` rows; the curve is computed on it.
    """
    n = num_thresholds
    if n < 2:
        raise ValueError("num_thresholds must be >= 2")
    p = F.col(prediction).cast("double")
    m = F.floor(p * (n - 1))
    mid = F.when(m / F.lit(float(n - 1)) < p, m).otherwise(m - 1)
    mid = F.least(F.greatest(mid, F.lit(0)), F.lit(n - 2))
    k = ((p > -THRESHOLD_EPSILON).cast("int") + mid.cast("int")
         + (p > 1 + THRESHOLD_EPSILON).cast("int"))
    hist = (df.select(k.alias("k"), F.col(label).cast("double").alias("y"))
            .groupBy("k").agg(F.sum("y").alias("pos"), F.sum(1.0 - F.col("y")).alias("neg")))
    # every bin 0..n, running sums over at most n + 1 rows
    bins = df.sparkSession.range(n + 1).select(F.col("id").cast("int").alias("k"))
    h = bins.join(hist, "k", "left").fillna(0.0, ["pos", "neg"])
    run = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    allw = Window.orderBy("k").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # threshold i: fn_i = positives with k <= i, tp_i = P - fn_i (same for negatives)
    c = h.select(F.col("k").alias("i"), F.sum("pos").over(run).alias("fn"),
                 F.sum("neg").over(run).alias("tn"),
                 F.sum("pos").over(allw).alias("P"), F.sum("neg").over(allw).alias("N"))
    c = c.filter(F.col("i") < n).select(
        "i", (F.col("P") - F.col("fn")).alias("tp"), "fn",
        (F.col("N") - F.col("tn")).alias("fp"), "tn")
    c = c.select("i", ((F.col("tp") + AUC_EPSILON) / (F.col("tp") + F.col("fn") + AUC_EPSILON)).alias("y"),
                 (F.col("fp") / (F.col("fp") + F.col("tn") + AUC_EPSILON)).alias("x"))
    w = Window.orderBy("i")  # over n rows only
    seg = c.select("x", "y", F.lead("x").over(w).alias("x2"), F.lead("y").over(w).alias("y2"))
    return seg.agg(F.sum(F.coalesce((F.col("x") - F.col("x2")) * (F.col("y") + F.col("y2")) / 2.0,
                                    F.lit(0.0))).alias("auc"))


def auc_exact(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Exact ROC AUC, ties counted one half (average ranks).

    ``sum_s pos_s * (neg_below_s + neg_s / 2) / (P * N)`` over distinct scores;
    ``neg_below`` is a running sum in score order, computed by a range-
    partitioned scan, so the number of distinct scores is not bounded by a task.
    """
    per = (df.select(F.col(prediction).cast("double").alias("s"), F.col(label).cast("double").alias("y"))
           .groupBy("s").agg(F.sum("y").alias("pos"), F.sum(1.0 - F.col("y")).alias("neg"))
           .withColumn("__all", F.lit(0)))
    sc = ordered_scan(per, ["__all"], [F.col("s").asc()], ["neg"], pos="__pos", method="range")
    term = F.col("pos") * (F.col("cum_neg") - F.col("neg") + F.col("neg") / 2.0)
    t = sc.agg(F.sum(term).alias("__u"), F.sum("pos").alias("__p"), F.sum("neg").alias("__n"))
    den = F.col("__p") * F.col("__n")
    return t.select(F.when(den > 0, F.col("__u") / den).otherwise(F.lit(None).cast("double")).alias("auc"))


def sigmoid(z) -> F.Column:
    z = F.col(z) if isinstance(z, str) else z
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def log_loss(df: DataFrame, label: str = "label", logit: str = "logit") -> DataFrame:
    """Mean sigmoid cross-entropy from logits, stable form."""
    z, y = F.col(logit).cast("double"), F.col(label).cast("double")
    term = F.greatest(z, F.lit(0.0)) - z * y + F.log1p(F.exp(-F.abs(z)))
    return df.agg(F.avg(term).alias("log_loss"), F.avg(sigmoid(z)).alias("mean_probability"))


# Exponents are split into bins this wide: e^BIN times any number of rows stays far inside a double.
BIN = 256.0


def _bin(x: Column) -> Column:
    """Lower end of the bin of ``x``."""
    return F.floor(x / BIN) * BIN


def _exp_state(x: Column) -> Column:
    """Term of a sum of exponentials, scaled by the lower end of its bin."""
    return F.exp(x - _bin(x))


def list_softmax(df: DataFrame, score: str = "score", out: str = "probability") -> DataFrame:
    """Softmax of scores within each list.

    The state of a list is its sums of exponentials per bin of scores, scaled by the bin; such states add up, so they
    are built by one aggregate with map-side combine over (list, bin), and put on the scale of the highest bin
    afterwards.  Rows are joined once with the finished one-row-per-list table; no aggregate follows on the join's
    key, so a list that holds half of all rows can be split.
    """
    z = F.col(score).cast("double")
    parts = df.groupBy("list_id", _bin(z).alias("__b")).agg(F.sum(_exp_state(z)).alias("__s"))
    top = F.max("__b").over(Window.partitionBy("list_id"))
    sums = (parts.withColumn("__top", top).groupBy("list_id", "__top")
            .agg(F.sum(F.col("__s") * F.exp(F.col("__b") - F.col("__top"))).alias("__se")))
    return df.join(sums, "list_id").withColumn(out, F.exp(z - F.col("__top")) / F.col("__se")).drop("__top", "__se")


def listwise_loss(df: DataFrame, label: str = "label", logit: str = "score") -> DataFrame:
    """Masked softmax cross-entropy, mean over lists.

    Per list: ``-sum_i softmax(labels)_i * log_softmax(logits)_i`` over the
    valid items (label >= 0); invalid items are masked out of both
    softmaxes.  Lists without a valid item are skipped.
    Returns ``(list_id, loss)``; ``mean_listwise_loss`` averages it.

    ``-sum p_i (z_i - log sum e^z) = log sum e^z - sum e^y z / sum e^y``: three sums of exponentials whose states,
    scaled by their bins as in ``list_softmax``, come from one aggregate; no row is joined with its list.
    """
    y, z = F.col(label).cast("double"), F.col(logit).cast("double")
    parts = (df.filter(F.col(label) >= 0).groupBy("list_id", _bin(y).alias("__by"), _bin(z).alias("__bz"))
             .agg(F.sum(_exp_state(y)).alias("__sy"), F.sum(_exp_state(z)).alias("__sz"), F.sum(_exp_state(y) * z).alias("__syz")))
    w = Window.partitionBy("list_id")
    top = parts.withColumn("__my", F.max("__by").over(w)).withColumn("__mz", F.max("__bz").over(w))
    sy, sz = F.exp(F.col("__by") - F.col("__my")), F.exp(F.col("__bz") - F.col("__mz"))
    t = top.groupBy("list_id", "__mz").agg(F.sum(F.col("__sy") * sy).alias("__sy"), F.sum(F.col("__sz") * sz).alias("__sz"),
                                           F.sum(F.col("__syz") * sy).alias("__syz"))
    return t.select("list_id", (F.col("__mz") + F.log("__sz") - F.col("__syz") / F.col("__sy")).alias("loss"))


def mean_listwise_loss(df: DataFrame, label: str = "label", logit: str = "score") -> DataFrame:
    return listwise_loss(df, label, logit).agg(F.avg("loss").alias("loss"))


def ctr_fit(df: DataFrame, categorical: list[str], numeric: list[str] | None = None,
            label: str = "label", hash_buckets: int = 10000, max_iter: int = 20, seed: int = 42):
    """Distributed CTR baseline: hashed one-hot features + logistic regression.

    Stands in for the reference's small dense network (a single-machine
    neural-network graph): the feature side (hash buckets, bucketized numbers)
    is the same, the model is Spark ML's distributed logistic regression.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import FeatureHasher

    numeric = numeric or []
    hasher = FeatureHasher(inputCols=list(categorical) + list(numeric), outputCol="features",
                           numFeatures=hash_buckets, categoricalCols=list(categorical))
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter)
    return Pipeline(stages=[hasher, lr]).fit(df.withColumn(label, F.col(label).cast("double")))


def ctr_score(model, df: DataFrame) -> DataFrame:
    """Batch scoring -> ``prediction`` = P(label = 1)."""
    from pyspark.ml.functions import vector_to_array as v2a
    out = model.transform(df)
    return out.withColumn("prediction", v2a("probability")[1]).drop("features", "rawPrediction", "probability")
