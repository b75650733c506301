"""Groups that hold a large share of all rows: same results as plain windows or brute force, and no plan that sends them to one task."""
import io
import math
import random
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from tessera.functions import scan
from tessera.operators import evaluate as J
from tessera.operators import ranking as R


@pytest.fixture
def lopsided(spark):
    """Null keys, small groups, and one group with most of the rows."""
    return spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 50).when(F.col("id") % 100 == 1, F.lit(None)).otherwise(F.lit(7)).alias("g"),
        F.when(F.col("id") % 2 == 0, "a").alias("h"), (F.col("id") * 7919 % 3001).alias("o"), (F.col("id") % 5).cast("double").alias("v"))


@pytest.mark.parametrize("hot_rows", [1, 40, 500, 100_000])
def test_auto_scan_is_the_window(lopsided, hot_rows):
    got = scan.ordered_scan(lopsided, ["g", "h"], ["o"], ["v"], hot_rows=hot_rows)
    want = scan.ordered_scan(lopsided, ["g", "h"], ["o"], ["v"], method="window")
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_only_hot_groups_leave_the_window(lopsided):
    assert scan.hot_groups(lopsided, ["g"], 5000) is None
    assert [r[0] for r in scan.hot_groups(lopsided, ["g"], 500).collect()] == [7]
    assert scan.hot_groups(lopsided.limit(0), ["g"], 0) is None


def brute_opa(items):
    num = den = 0.0
    for a in items:
        for b in items:
            if a[1] > b[1] >= 0:
                den += a[3]
                num += a[3] * (a[2] > b[2])
    return (num / den if den else 0.0), den


@pytest.mark.parametrize("hot_rows", [100, 100_000])
def test_opa_of_real_valued_labels_and_a_hot_list(spark, monkeypatch, hot_rows):
    rng = random.Random(1)
    items = {k: [(f"i{j}", rng.choice([-1.0, 0.0, 1.0, 2.0, rng.random() * 9]), float(rng.randrange(6)), rng.choice([0.5, 1.0, 2.0]))
                 for j in range(n)] for k, n in {1: 400, 2: 1, 3: 2, 4: 7, 5: 30, 6: 0}.items()}
    items[7] = [("a", 1.0, 1.0, 1.0), ("b", 1.0, 2.0, 1.0)]  # one grade
    items[8] = [("a", -1.0, 1.0, 1.0)]  # nothing valid
    df = spark.createDataFrame([(k, *r) for k, rs in items.items() for r in rs], "list_id long, item_id string, label double, score double, weight double")
    prepared = R.prepare_lists(df)
    monkeypatch.setattr(R, "hot_groups", lambda x, keys: scan.hot_groups(x, keys, hot_rows))
    got = {r["list_id"]: (r["opa"], r["weight"]) for r in R.opa(prepared).collect()}
    scores = {}
    for r in prepared.collect():
        if r["valid"]:
            scores.setdefault(r["list_id"], []).append((r["item_id"], r["label"], r["score"], r["weight"]))
    assert set(got) == set(scores)
    for k, rs in scores.items():
        assert got[k] == pytest.approx(brute_opa(rs), abs=1e-9)


def test_opa_rows_grow_with_the_logarithm_of_the_grades(spark, monkeypatch):
    """20,000 distinct labels in one list: at most 15 node rows an item."""
    df = spark.range(0, 20_000).select(F.lit(1).alias("list_id"), F.col("id").cast("string").alias("item_id"), F.col("id").cast("double").alias("label"),
                                       (F.col("id") * 7919 % 20_011).cast("double").alias("score"))
    seen, real = [], scan.ordered_scan
    monkeypatch.setattr(R, "hot_groups", lambda x, keys: scan.hot_groups(x, keys, 1000))
    monkeypatch.setattr(R, "ordered_scan", lambda x, *a, **kw: seen.append(x) or real(x, *a, **kw))
    out = R.opa(R.prepare_lists(df, weight=None)).collect()
    assert len(out) == 1 and out[0]["weight"] == 20_000 * 19_999 / 2 and 0.4 < out[0]["opa"] < 0.6
    assert seen[-1].count() <= 20_000 * 15


def exchanges_after_joins(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.mark.parametrize("scale", [1.0, 300.0, 1e5])
def test_softmax_and_loss_with_a_hot_list(spark, scale):
    rng = random.Random(2)
    rows = [(1 if j % 2 else rng.randrange(2, 9), rng.choice([-1.0, 0.0, 1.0, 3.0, 700.0]), rng.uniform(-1, 1) * scale) for j in range(1000)]
    rows += [(50, -1.0, 3.0), (51, 2.0, -700.0), (52, 0.0, 0.0), (52, 0.0, None)]
    df = spark.createDataFrame(rows, "list_id long, label double, score double")
    lists = {}
    for k, y, z in rows:
        lists.setdefault(k, []).append((y, z))
    for r in J.list_softmax(df).where("score is not null").collect():
        z = [b for _, b in lists[r["list_id"]] if b is not None]
        assert r["probability"] == pytest.approx(math.exp(r["score"] - max(z)) / sum(math.exp(b - max(z)) for b in z), rel=1e-9, abs=1e-300)
    got = {r["list_id"]: r["loss"] for r in J.listwise_loss(df.where("score is not null")).collect()}
    assert 50 not in got
    for k, loss in got.items():
        v = [(y, z) for y, z in lists[k] if y >= 0 and z is not None]
        my, mz = max(y for y, _ in v), max(z for _, z in v)
        sy = sum(math.exp(y - my) for y, _ in v)
        want = mz + math.log(sum(math.exp(z - mz) for _, z in v)) - sum(math.exp(y - my) * z for y, z in v) / sy
        assert loss == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_loss_has_no_join_and_softmax_no_aggregate_above_its_join(spark):
    df = spark.createDataFrame([(1, 0.0, 1.0)], "list_id long, label double, score double")
    assert "Join" not in exchanges_after_joins(J.listwise_loss(df))
    plan = exchanges_after_joins(J.list_softmax(df))
    assert plan.index("Join") < plan.index("Aggregate")  # printed from the top: the join comes after the aggregates
