"""Retrieval, ranking, list utilities and prediction metrics against direct
numpy formulations on small hand-made tables."""
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators import evaluate as J
from tessera.operators import lists as L
from tessera.operators import ranking as R
from tessera.operators import retrieval


def test_retrieval_metrics_hand_example(spark):
    beh = spark.createDataFrame(
        [("u1", "a", 1.0, 1), ("u1", "b", 2.0, 2), ("u1", "c", 0.0, 3), ("u1", "z", 1.0, 4),
         ("u2", "a", 1.0, 1), ("u2", "c", 1.0, 2),
         ("u3", "b", 1.0, 5)],                       # one event: no pair
        "user string, item string, relevance double, timestamp long")
    i2i = spark.createDataFrame(
        [("a", "b", 0.9), ("a", "c", 0.5), ("b", "x", 0.8), ("b", "c", 0.7)],  # c, z: no list
        "item1 string, item2 string, score double")
    m = {r["k"]: r for r in retrieval.retrieval_metrics(beh, i2i, [1, 2]).collect()}
    # pairs: (a->b hit@1), (b->c hit@2), (c->z no list), (a->c hit@2)
    assert m[1]["n_pairs"] == 4
    assert m[1]["recall"] == pytest.approx(1 / 4)
    assert m[2]["recall"] == pytest.approx(3 / 4)
    assert m[1]["precision"] == pytest.approx(1 / 3)        # tp+fp = 1 + 1 + 0 + 1
    assert m[2]["precision"] == pytest.approx(3 / 6)
    assert m[2]["mrr"] == pytest.approx((1 + 0.5 + 0.5) / 4)
    # relevance 0 at the b->c hit gives ndcg 0
    assert m[2]["ndcg"] == pytest.approx((1 + 1 / math.log2(3)) / 4)


def tf_like(lists, n=None):
    """Direct per-list numpy evaluation of the metric definitions."""
    out = {}
    for lid, items in lists.items():
        lab = np.array([max(l, 0.0) for _, l, _, _ in items])
        valid = np.array([l >= 0 for _, l, _, _ in items])
        sc = np.array([s for _, _, s, _ in items])
        sc = np.where(valid, sc, sc.min() - 1e-6)
        w = np.array([w for *_, w in items])
        ids = [i for i, *_ in items]
        order = sorted(range(len(items)), key=lambda i: (-sc[i], ids[i]))
        k = len(order) if n is None else min(n, len(order))
        top = order[:k]
        rel = (lab >= 1).astype(float)
        gain = 2 ** lab - 1
        disc = lambda r: 1 / math.log2(1 + r)
        dcg = sum(w[i] * gain[i] * disc(r + 1) for r, i in enumerate(top))
        iorder = sorted(range(len(items)), key=lambda i: (-(w[i] * lab[i]), ids[i]))[:k]
        idcg = sum(w[i] * gain[i] * disc(r + 1) for r, i in enumerate(iorder))
        cum, prec = 0, 0.0
        for r, i in enumerate(top):
            cum += rel[i]
            prec += cum / (r + 1) * w[i] * rel[i]
        trel = sum(w[i] * rel[i] for i in top)
        out[lid] = dict(
            mrr=max([rel[i] / (r + 1) for r, i in enumerate(top)] + [0.0]),
            precision=sum(rel[i] for i in top) / k,
            map=prec / trel if trel else 0.0,
            ndcg=dcg / idcg if idcg else 0.0, dcg_raw=dcg,
            wr=(sum(w * rel), sum(rel)), wg=(sum(w * gain), sum(gain)))
    return out


def list_weight(vals):
    per = {l: (wr / r if r > 0 else 0.0, r) for l, (wr, r) in vals.items()}
    nz = [p for p, r in per.values() if r > 0]
    avg = sum(nz) / len(nz) if nz else 0.0
    return {l: (p if r > 0 else avg) for l, (p, r) in per.items()}


@pytest.fixture(scope="module")
def random_lists():
    rnd = random.Random(3)
    data = []
    for lid in range(40):
        for j in range(rnd.randint(1, 9)):
            lab = rnd.choice([-1.0, 0.0, 0.0, 1.0, 2.0, 3.0])
            data.append((lid, f"i{j}", lab, round(rnd.random(), 2), rnd.choice([1.0, 0.5, 2.0])))
    return data


@pytest.mark.parametrize("n", [None, 1, 3])
def test_ranking_metrics_match_direct_formulas(spark, random_lists, n):
    df = spark.createDataFrame(random_lists, "list_id long, item_id string, label double, score double, weight double")
    p = R.prepare_lists(df)
    lists = defaultdict(list)
    for lid, iid, lab, s, w in random_lists:
        lists[lid].append((iid, lab, s, w))
    want = tf_like(lists, n)
    wb = list_weight({l: v["wr"] for l, v in want.items()})
    wg = list_weight({l: v["wg"] for l, v in want.items()})
    for name, fn, key, weights in [("mrr", R.mrr, "mrr", wb), ("precision", R.precision_at, "precision", wb),
                                    ("map", R.mean_average_precision, "map", wb), ("ndcg", R.ndcg, "ndcg", wg)]:
        got = {r["list_id"]: (r[key], r["weight"]) for r in fn(p, n).collect()}
        for lid, v in want.items():
            assert got[lid][0] == pytest.approx(v[key], abs=1e-9), (name, lid)
            assert got[lid][1] == pytest.approx(weights[lid], abs=1e-9), (name, lid)
    got = {r["list_id"]: r["dcg"] for r in R.dcg(p, n).collect()}
    for lid, v in want.items():
        exp = v["dcg_raw"] / wg[lid] if wg[lid] else 0.0
        assert got[lid] == pytest.approx(exp, abs=1e-9)


def test_opa_matches_pairs(spark, random_lists):
    df = spark.createDataFrame(random_lists, "list_id long, item_id string, label double, score double, weight double")
    got = {r["list_id"]: (r["opa"], r["weight"]) for r in R.opa(R.prepare_lists(df)).collect()}
    lists = defaultdict(list)
    for lid, iid, lab, s, w in random_lists:
        if lab >= 0:
            lists[lid].append((lab, s, w))
    for lid, it in lists.items():
        c = sum(a[2] for a in it for b in it if a[0] > b[0] and a[1] > b[1])
        t = sum(a[2] for a in it for b in it if a[0] > b[0])
        assert got[lid][1] == pytest.approx(t)
        assert got[lid][0] == pytest.approx(c / t if t else 0.0)


def test_all_unit_weights_give_unit_list_weights(spark):
    df = spark.createDataFrame([(1, "a", 0.0, 0.3), (1, "b", 0.0, 0.1), (2, "a", 2.0, 0.5), (3, "x", -1.0, 0.2)],
                               "list_id long, item_id string, label double, score double")
    w = R.list_weights(R.prepare_lists(df, weight=None), F.when(F.col("label") >= 1, 1.0).otherwise(0.0))
    assert {r["weight"] for r in w.collect()} == {1.0}


def test_only_invalid_labels_list(spark):
    df = spark.createDataFrame([(1, "a", -1.0, 0.3), (1, "b", -1.0, 0.9)],
                               "list_id long, item_id string, label double, score double")
    p = R.prepare_lists(df, weight=None)
    assert [r["ndcg"] for r in R.ndcg(p).collect()] == [0.0]
    assert [r["mrr"] for r in R.mrr(p).collect()] == [0.0]


def test_sorted_ranks_worked_example(spark):
    df = spark.createDataFrame([(1, "x0", 1.0), (1, "x1", 3.5), (1, "x2", 2.1)], "list_id long, item_id string, score double")
    assert rows(L.sorted_ranks(df), "item_id", "rank") == [("x0", 3), ("x1", 1), ("x2", 2)]


def test_circular_padding_worked_example(spark):
    df = spark.createDataFrame([(1, "a", True, 0), (1, "b", True, 1), (1, "c", False, 2),
                                (2, "z", False, 0)],
                               "list_id long, item_id string, valid boolean, position long")
    got = rows(L.pad_circular(df, 3), "list_id", "slot", "item_id", "mask")
    assert got == [(1, 0, "a", True), (1, 1, "b", True), (1, 2, "a", False),
                   (2, 0, "z", False), (2, 1, "z", False), (2, 2, "z", False)]


def test_de_noise_rows_are_simplices(spark):
    rnd = random.Random(5)
    counts, noise = [], []
    for l in range(20):
        for k in range(8):
            counts.append((l, f"k{k}", float(rnd.choice([0, 0, 1, 2, 5, 9]))))
            noise.append((l, f"k{k}", rnd.random() + 0.01))
    c = spark.createDataFrame(counts, "list_id long, key string, count double")
    n = spark.createDataFrame(noise, "list_id long, key string, noise double")
    out = L.de_noise(c, n, 0.9)
    sums = defaultdict(float)
    for r in out.collect():
        assert r["value"] >= -1e-12
        sums[r["list_id"]] += r["value"]
    assert all(abs(s - 1) < 1e-9 for s in sums.values())


def test_de_noise_keeps_every_list_and_key(spark):
    c = spark.createDataFrame([(1, "a", 0.0), (1, "b", 0.0), (2, "a", 3.0), (2, "b", 0.0)], "list_id long, key string, count double")
    n = c.select("list_id", "key", F.lit(1.0).alias("noise"))
    assert rows(L.de_noise(c, n), "list_id", "key", "value") == [(1, "a", 0.0), (1, "b", 0.0), (2, "a", pytest.approx(1.0)), (2, "b", 0.0)]
    with pytest.raises(Exception, match="noise"):
        L.de_noise(c, n.filter("list_id = 1")).collect()


def test_de_noise_rejects_bad_ratio(spark):
    c = spark.createDataFrame([(1, "a", 1.0)], "list_id long, key string, count double")
    with pytest.raises(ValueError):
        L.de_noise(c, c.withColumnRenamed("count", "noise"), 1.0)


def test_auc_exact_and_binned(spark):
    rnd = random.Random(1)
    data = [(float(y), round(min(max(0.3 * y + rnd.random() * 0.7, 0.0), 1.0), 2)) for y in
            [rnd.randint(0, 1) for _ in range(400)]]
    df = spark.createDataFrame(data, "label double, prediction double")
    pos = [p for y, p in data if y == 1]
    neg = [p for y, p in data if y == 0]
    want = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    assert J.auc_exact(df).first()["auc"] == pytest.approx(want, abs=1e-12)
    assert J.auc_binned(df, 1000).first()["auc"] == pytest.approx(want, abs=5e-3)


def test_log_loss_and_listwise_loss(spark):
    data = [(1.0, 2.0), (0.0, -1.0), (1.0, -0.5), (0.0, 3.0)]
    df = spark.createDataFrame(data, "label double, logit double")
    want = np.mean([-(y * math.log(1 / (1 + math.exp(-z))) + (1 - y) * math.log(1 - 1 / (1 + math.exp(-z))))
                    for y, z in data])
    assert J.log_loss(df).first()["log_loss"] == pytest.approx(want)
    lst = spark.createDataFrame([(1, 2.0, 0.5), (1, 0.0, 0.1), (1, -1.0, 9.0), (2, 1.0, 0.0)],
                                "list_id long, label double, score double")
    got = {r["list_id"]: r["loss"] for r in J.listwise_loss(lst).collect()}
    y, z = np.array([2.0, 0.0]), np.array([0.5, 0.1])
    p = np.exp(y) / np.exp(y).sum()
    assert got[1] == pytest.approx(-(p * (z - np.log(np.exp(z).sum()))).sum())
    assert got[2] == pytest.approx(0.0)


def test_hot_list_metrics_match_window_plan(spark):
    # one list holds a third of all rows: the range plan must agree with the
    # single-window plan
    rnd = random.Random(8)
    data = [(0, f"h{j}", float(rnd.randint(0, 3)), rnd.random(), 1.0) for j in range(3000)]
    data += [(l, f"i{j}", float(rnd.randint(-1, 3)), rnd.random(), 1.0) for l in range(1, 600) for j in range(10)]
    df = spark.createDataFrame(data, "list_id long, item_id string, label double, score double, weight double")
    p = R.prepare_lists(df)
    for fn in (lambda m: R.ndcg(p, 20, method=m), lambda m: R.mean_average_precision(p, None, method=m),
               lambda m: R.opa(p, method=m)):
        a = sorted((r[0], round(r[1], 9), round(r[2], 9)) for r in fn("range").collect())
        b = sorted((r[0], round(r[1], 9), round(r[2], 9)) for r in fn("window").collect())
        assert a == b


def test_diversity_metrics_with_invalid_labels(spark):
    # list 1: item c has only padding labels (-1) -> invalid, sorts last
    cells = [(1, "a", "t1", 1.0, 0.9), (1, "a", "t2", 0.0, 0.9), (1, "b", "t1", 1.0, 0.5),
             (1, "b", "t2", 1.0, 0.5), (1, "c", "t1", -1.0, 0.99), (1, "c", "t2", -1.0, 0.99),
             (2, "x", "t1", 0.0, 0.3), (2, "y", "t1", 0.0, 0.2)]
    df = spark.createDataFrame(cells, "list_id long, item_id string, subtopic string, label double, score double")
    items, cl = R.prepare_diversity(df, weight=None)
    it = {(r.list_id, r.item_id): r for r in items.collect()}
    assert not it[(1, "c")].valid and it[(1, "c")].score == pytest.approx(0.5 - 1e-6)
    pia = {r.list_id: r.precision_ia for r in R.precision_ia(items, cl, 2).collect()}
    # top 2 of list 1: a (t1), b (t1, t2) -> 3 relevant cells / (2 subtopics * 2 items)
    assert pia[1] == pytest.approx(3 / 4) and pia[2] == 0.0
    ad = {r.list_id: (r.alpha_dcg, r.weight) for r in R.alpha_dcg(items, cl, None, 0.5).collect()}
    # a at rank 1: gain 1 (t1); b at rank 2: t1 seen once -> 0.5, t2 new -> 1; c: labels cleaned to 0
    want = 1.0 / math.log2(2) + 1.5 / math.log2(3)
    assert ad[1][0] == pytest.approx(want / ad[1][1]) and ad[1][1] == pytest.approx(1.0)
    assert ad[2][0] == 0.0
