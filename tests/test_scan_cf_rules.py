"""Scans, item CF, pairs and association rules on hand-made tables."""
import itertools
import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.functions.indexing import global_index
from tessera.functions.scan import ordered_scan
from tessera.operators import cf, itemsets, rules
from tessera.operators.pairs import group_pairs
from tessera.operators.topn import tie_key, top_n


def test_ordered_scan_matches_window_on_hot_key(spark):
    # one key holds a third of all rows and spans several ranges
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("k"),
        "id", (F.col("id") % 11).cast("double").alias("v"))
    a = ordered_scan(df, ["k"], [F.col("id").desc()], ["v"], num_partitions=12)
    b = ordered_scan(df, ["k"], [F.col("id").desc()], ["v"], method="window")
    assert rows(a) == rows(b)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_ordered_scan_without_exchange_reuse(spark, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        df = spark.range(0, 20000).repartition(7).select((F.col("id") % 3).alias("k"), "id", F.lit(1.0).alias("one"))
        got = ordered_scan(df.join(df.select("id"), "id").select("k", "id", "one"), ["k"], ["id"], ["one"], num_partitions=11).collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert all(r["pos"] == r["id"] // 3 + 1 == r["cum_one"] for r in got) and len(got) == 20000


def test_ordered_scan_keeps_values(spark):
    big = 2 ** 53
    df = spark.sql(f"""SELECT * FROM VALUES (CAST(NULL AS BIGINT), 1, CAST(NULL AS BIGINT), timestamp'1500-01-01 00:00:00'),
        ({big + 1}, 2, {big + 1}, NULL), ({big}, 3, 5, timestamp'2020-01-01 00:00:00'), (NULL, 4, {big + 1}, NULL) AS t(k, o, v, ts)""")
    got = {r["o"]: r for r in ordered_scan(df, ["k"], ["o"], num_partitions=3).collect()}
    assert {o: (r["k"], r["pos"], r["v"]) for o, r in got.items()} == {
        1: (None, 1, None), 2: (big + 1, 1, big + 1), 3: (big, 1, 5), 4: (None, 2, big + 1)}
    assert got[1]["ts"].year == 1500


def test_top_n_ranks_any_magnitude(spark):
    for scale in (1e-12, 1.0, 1e12, 1e200):
        df = spark.createDataFrame([("g", i, i * scale) for i in range(1, 41)], "g string, i long, x double")
        assert rows(top_n(df, "g", [tie_key("x").desc()], 3), "i") == [(38,), (39,), (40,)]
    noisy = spark.createDataFrame([("g", 0, 0.1 + 0.2), ("g", 1, 0.3), ("g", 2, 0.2)], "g string, i long, x double")
    assert rows(top_n(noisy, "g", [tie_key("x").desc()], 1), "i") == [(0,), (1,)]


def test_item_cf_keeps_very_active_users(spark):
    df = spark.range(0, 3100).select(F.lit(1).alias("user"), F.col("id").alias("item"), F.lit(1.0).alias("rating"))
    assert cf.filter_users(cf.dedupe_ratings(df)).count() == 3100


def test_global_index_dense_and_ordered(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("x"))
    g = global_index(df, ["x"], "idx", num_partitions=7)
    r = sorted((x, i) for x, i in g.collect())
    assert [i for _, i in r] == list(range(5000))


def brute_item_cf(data, top, lower, upper):
    best = {}
    for u, i, r in data:
        best[(u, i)] = max(best.get((u, i), -1e300), r)
    per_user = defaultdict(dict)
    for (u, i), r in best.items():
        per_user[u][i] = r
    per_user = {u: d for u, d in per_user.items() if lower <= len(d) <= upper}
    pop = defaultdict(int)
    for d in per_user.values():
        for i in d:
            pop[i] += 1
    acc = defaultdict(lambda: [0.0, 0])
    for d in per_user.values():
        if len(d) < 2:
            continue
        for a, b in itertools.combinations(sorted(d), 2):
            acc[(a, b)][0] += 1 / (1 + abs(d[a] - d[b])) / math.log1p(len(d))
            acc[(a, b)][1] += 1
    sims = defaultdict(list)
    for (a, b), (s, n) in acc.items():
        v = s / n / math.sqrt(pop[a] * pop[b])
        sims[a].append((b, v))
        sims[b].append((a, v))
    out = set()
    for a, lst in sims.items():
        for b, v in lst:
            rank = 1 + sum(1 for _, w in lst if round(w, 10) > round(v, 10))
            if rank <= top:
                out.add((a, b, round(v, 9)))
    return out


def test_item_cf_matches_brute_force_with_edge_cases(spark):
    data = [("u1", "a", 5.0), ("u1", "b", 3.0), ("u1", "c", 4.0), ("u1", "a", 1.0),  # repeat
            ("u2", "a", 4.0), ("u2", "b", 4.0),
            ("u3", "c", 2.0),                                                      # one item
            ("u4", "a", 1.0), ("u4", "b", 2.0), ("u4", "c", 3.0), ("u4", "d", 3.0),
            ("u5", "d", 5.0), ("u5", "e", 5.0)]
    df = spark.createDataFrame(data, "user string, item string, rating double")
    got = {(a, b, round(s, 9)) for a, b, s in cf.item_cf(df, top=2).collect()}
    assert got == brute_item_cf(data, 2, 2, 3000)
    # upper bound drops the 4-item user
    got = {(a, b, round(s, 9)) for a, b, s in cf.item_cf(df, top=10, upper=3).collect()}
    assert got == brute_item_cf(data, 10, 2, 3)


def test_item_cf_symmetric(spark):
    data = [(u, i, float((u * i) % 5)) for u in range(30) for i in range(u % 7, u % 7 + 5)]
    df = spark.createDataFrame(data, "user long, item long, rating double")
    s = {(a, b): v for a, b, v in cf.item_cf(df, top=1000).collect()}
    assert all(abs(s[(b, a)] - v) < 1e-12 for (a, b), v in s.items())


@pytest.mark.parametrize("block", [1, 2, 3, 1000])
def test_group_pairs_exact_for_any_block_size(spark, block):
    data = [(g, i) for g in range(4) for i in range(g * 3 + 1)] + [(9, i) for i in range(40)]
    df = spark.createDataFrame(data, "g long, item long")
    df = df.join(df.groupBy("g").agg(F.count("*").alias("n")), "g")
    got = rows(group_pairs(df, ["g"], "item", "n", (), block_size=block), "g", "item_lo", "item_hi")
    want = sorted((g, a, b) for g in {g for g, _ in data}
                  for a, b in itertools.combinations(sorted(i for gg, i in data if gg == g), 2))
    assert got == want


def test_min_support_never_rounds_up():
    n = 25
    assert math.ceil(rules.min_support(7, n) * n) == 7
    assert math.ceil(rules.min_support(3, 7) * 7) == 3


def test_fp_growth_and_pair_plans_agree(spark):
    tx = ["a b c", "a b", "a c", "b c d", "a b d d", "a", "b c", "a b c d", "c d", "a d"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tx)], "tid long, items string")
    from tessera.sources import read_transactions
    t = read_transactions(df, "items")
    a = rows(rules.fp_rules(t, "items", 2, 0.1, 10).select(
        "antecedent", "consequent", F.round("lift", 9).alias("l")))
    b = rows(rules.pair_rules(t, "items", 2, 0.1, 10, tid="tid", block_size=2).select(
        "antecedent", "consequent", F.round("lift", 9).alias("l")))
    assert a == b and len(a) > 0


def test_ordered_scan_null_keys_form_one_group(spark):
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 3).alias("k"),
        "id", F.lit(1.0).alias("v"))
    a = ordered_scan(df, ["k"], ["id"], ["v"], num_partitions=9)
    b = ordered_scan(df, ["k"], ["id"], ["v"], method="window")
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_ordered_scan_on_shuffled_input_with_constant_columns(spark):
    # upstream aggregate (row order varies run to run) plus a literal column:
    # neither may make the two branches see different range assignments
    base = spark.range(0, 100000).select((F.col("id") % 500).alias("g"), "id")
    agg = base.groupBy("g", (F.col("id") % 37).alias("h")).agg(F.count("*").alias("c"), F.sum("id").alias("s"))
    df = agg.select(F.when(F.col("g") < 200, 0).otherwise(F.col("g")).alias("k"), "g", "h", "c", "s",
                    F.lit(1.0).alias("w"))
    a = ordered_scan(df, ["k"], [F.col("s").desc(), "g", "h"], ["c", "w"], num_partitions=7)
    b = ordered_scan(df, ["k"], [F.col("s").desc(), "g", "h"], ["c", "w"], method="window")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_job_entry_points(spark):
    from tessera.plans import jobs
    data = [("u1", "a", 5.0), ("u1", "b", 3.0), ("u2", "a", 4.0), ("u2", "b", 4.0), ("u2", "c", 1.0)]
    spark.createDataFrame(data, "user string, item string, rating double").createOrReplaceTempView("tessera_ratings")
    sims = jobs.item_cf_job(spark, "tessera_ratings", top_n=5)
    assert {(r.item1, r.item2) for r in sims.collect()} >= {("a", "b"), ("b", "a")}
    spark.createDataFrame([("a b c",), ("a b",), ("a c",), ("a b c",)], "items string") \
        .createOrReplaceTempView("tessera_baskets")
    r = jobs.fp_growth_job(spark, "tessera_baskets", min_support_count=2)
    assert r.count() > 0
    vec = spark.createDataFrame([(i, [float(i % 3), 1.0, float(i % 5)]) for i in range(30)], "id long, vector array<double>")
    nn = jobs.nearest_neighbor_job(spark, vec, algorithm="brute", metric="l2", k=2)
    assert nn.columns == ["itemId", "candidateId", "distance"] and nn.count() == 60


def test_job_entry_points_metrics_and_embeddings(spark):
    from tessera.plans import jobs
    beh = spark.createDataFrame([("u1", "a", 1.0, 1), ("u1", "b", 1.0, 2), ("u2", "a", 1.0, 1), ("u2", "c", 1.0, 2)],
                                "user string, item string, relevance double, timestamp long")
    i2i = spark.createDataFrame([("a", "b", 0.9), ("a", "c", 0.5)], "item1 string, item2 string, score double")
    m = {r.k: r for r in jobs.recall_metrics_job(spark, beh, i2i, [1, 2]).collect()}
    assert m[1].recall == 0.5 and m[2].recall == 1.0
    seq = spark.createDataFrame([(u, ",".join(f"i{(u * 7 + j) % 12}" for j in range(20))) for u in range(30)],
                                "user_id long, item_ids string")
    vectors, sims = jobs.embedding_job(spark, seq, vector_size=8, min_count=1, max_iter=2, negative=3,
                                       sample=0.0, num_partitions=2, top_n=3)
    assert vectors.count() == 12 and sims.groupBy("item1").count().agg(F.max("count")).first()[0] <= 3


def test_item_cf_hot_user_split_into_blocks(spark):
    # one user holds most rows; tiny blocks force the split pair join
    data = [("hot", f"i{j}", float(j % 5)) for j in range(60)]
    data += [(f"u{u}", f"i{(u * 7 + j) % 60}", float((u + j) % 4)) for u in range(20) for j in range(4)]
    df = spark.createDataFrame(data, "user string, item string, rating double")
    got = {(a, b, round(s, 9)) for a, b, s in cf.item_cf(df, top=5, block_size=4).collect()}
    assert got == brute_item_cf(data, 5, 2, 3000)


# --- itemsets level by level ---------------------------------------------------------------------------------------------

def brute_itemsets(baskets, min_count, max_size):
    out = {}
    for size in range(1, max_size + 1):
        counts = defaultdict(int)
        for b in baskets:
            for c in itertools.combinations(sorted({i for i in b if i is not None}), size):
                counts[c] += 1
        out.update({c: n for c, n in counts.items() if n >= min_count})
    return out


def some_baskets():
    rng = random.Random(11)
    rows = [(t, [rng.choice("abcdefghij") for _ in range(rng.randrange(0, 9))]) for t in range(120)]
    # abx, abc, acx, bcx are frequent but no set of four; a hot basket; nulls and repeats
    rows += [(200 + i, list(s)) for i, s in enumerate(["klm", "kln", "kmn", "lmn"] * 4)]
    return rows + [(300, [f"h{i}" for i in range(60)] + ["a", "a", None]), (301, []), (302, None), (None, ["a", "b"])]


@pytest.mark.parametrize("min_count, max_size, block", [(3, 4, 512), (10, 3, 4), (1, 2, 7), (1000, 3, 512)])
def test_level_itemsets_match_brute_force(spark, min_count, max_size, block):
    rows = some_baskets()
    df = spark.createDataFrame(rows, "tid long, items array<string>")
    got = {tuple(r["items"]): r["freq"] for r in itemsets.level_itemsets(df, "tid", "items", min_count, max_size, block).collect()}
    assert got == brute_itemsets([b or [] for t, b in rows if t is not None], min_count, max_size)


def test_candidates_without_a_subset_are_pruned(spark):
    triples = ["abc", "abd", "acd", "bcd", "abe", "ace"]  # abcd has all its subsets, abce lacks bce, abde lacks ade and bde
    df = spark.createDataFrame([(list(t[:2]), t[2], 5) for t in triples], "head array<string>, last string, freq long")
    assert {("".join(r["head"]), r["last"]) for r in itemsets.candidates(df).collect()} == {("abc", "d")}


def test_itemset_rules_match_fp_growth(spark):
    rows = [(t, b) for t, b in some_baskets() if t is not None and b and None not in b]
    df = spark.createDataFrame(rows, "tid long, items array<string>")
    found = itemsets.level_itemsets(df, "tid", "items", 4, 4)
    ours = {(tuple(r["antecedent"]), r["consequent"], round(r["confidence"], 9), round(r["lift"], 9), round(r["support"], 9))
            for r in itemsets.itemset_rules(found, len(rows), 0.2).collect()}
    theirs = {(tuple(sorted(r["antecedent"])), r["consequent"][0], round(r["confidence"], 9), round(r["lift"], 9), round(r["support"], 9))
              for r in rules.association_rules(df, "items", 4, 0.2).collect() if len(r["antecedent"]) <= 3}
    assert ours == theirs and any(len(r[0]) == 2 for r in ours)
    assert itemsets.level_itemsets(df.limit(0), "tid").count() == 0
