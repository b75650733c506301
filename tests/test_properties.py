"""Property tests (hypothesis, few examples: every example is a Spark job)."""
import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions.scan import ordered_scan
from tessera.operators.pairs import group_pairs
from tessera.operators.topn import top_n

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 50),
                             st.floats(-5, 5, allow_nan=False)), min_size=1, max_size=120)


@SETTINGS
@given(rows=rows_st, parts=st.integers(1, 9))
def test_ordered_scan_equals_window(spark, rows, parts):
    data = [(k, i, o, v) for i, (k, o, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, i long, o long, v double")
    order = [F.col("o").desc(), F.col("i").asc()]
    a = ordered_scan(df, ["k"], order, ["v"], num_partitions=parts)
    b = ordered_scan(df, ["k"], order, ["v"], method="window")
    ra = sorted(((r.k, r.i, r.pos, round(r.cum_v, 9)) for r in a.collect()), key=repr)
    rb = sorted(((r.k, r.i, r.pos, round(r.cum_v, 9)) for r in b.collect()), key=repr)
    assert ra == rb


@SETTINGS
@given(groups=st.lists(st.sets(st.integers(0, 40), max_size=25), min_size=1, max_size=6),
       block=st.integers(1, 10))
def test_group_pairs_are_exactly_the_pairs(spark, groups, block):
    data = [(g, i, len(s)) for g, s in enumerate(groups) for i in s]
    if not data:
        return
    df = spark.createDataFrame(data, "g long, item long, n long")
    got = sorted((r.g, r.item_lo, r.item_hi) for r in group_pairs(df, ["g"], "item", "n", (), block).collect())
    want = sorted((g, a, b) for g, s in enumerate(groups) for a, b in itertools.combinations(sorted(s), 2))
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9)), min_size=1, max_size=80),
       n=st.integers(1, 4))
def test_top_n_rank_keeps_ties(spark, rows, n):
    data = [(g, i, s) for i, (g, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "g long, i long, s long")
    got = sorted((r.g, r.i) for r in top_n(df, "g", [F.col("s").desc()], n).collect())
    want = []
    for g in {g for g, _, _ in data}:
        scores = [s for gg, _, s in data if gg == g]
        for gg, i, s in data:
            if gg == g and 1 + sum(x > s for x in scores) <= n:
                want.append((g, i))
    assert got == sorted(want)
