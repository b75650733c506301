"""k-NN / LSH against numpy brute force, embeddings, samples, sources."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from tessera.operators import corpus as C
from tessera.operators import embed as E
from tessera.operators import knn as K
from tessera.operators import lsh as H
from tessera.operators import samples as I
from tessera.operators import sgns as S
from tessera import sources as IO


def brute(vecs, k, metric):
    out = set()
    ids = sorted(vecs)
    for a in ids:
        cand = []
        for b in ids:
            if a == b:
                continue
            x, y = np.asarray(vecs[a], float), np.asarray(vecs[b], float)
            if metric == "cosine":
                if not np.any(x) or not np.any(y):
                    continue
                d = 1 - abs(x @ y) / (np.linalg.norm(x) * np.linalg.norm(y))
            elif metric == "l2":
                d = float(np.sqrt(((x - y) ** 2).sum()))
            else:
                sa, sb = set(vecs[a]), set(vecs[b])
                if not sa or not sb:
                    continue
                d = 1 - len(sa & sb) / len(sa | sb)
            cand.append((round(d, 10), b, d))
        if metric == "cosine" and not np.any(np.asarray(vecs[a], float)):
            continue
        if metric == "jaccard" and not vecs[a]:
            continue
        for _, b, d in sorted(cand)[:k]:
            out.add((a, b, round(d, 8)))
    return out


@pytest.fixture(scope="module")
def vec_df(spark):
    rnd = np.random.default_rng(0)
    vecs = {i: [float(x) for x in rnd.normal(size=6).round(1)] for i in range(60)}
    vecs[60] = [0.0] * 6              # zero vector: excluded for cosine
    vecs[61] = list(vecs[5])          # duplicate of 5: distance 0
    df = spark.createDataFrame([(i, v) for i, v in vecs.items()], "id long, vector array<double>")
    return vecs, df


@pytest.mark.parametrize("metric", ["cosine", "l2"])
@pytest.mark.parametrize("block", [7, 1000])
def test_knn_matches_brute_force(spark, vec_df, metric, block):
    vecs, df = vec_df
    got = {(a, b, round(d, 8)) for a, b, d in K.knn_self(df, 4, metric, block_size=block).collect()}
    assert got == brute(vecs, 4, metric)


def test_knn_jaccard_with_empty_set(spark):
    rnd = random.Random(2)
    sets = {i: sorted(rnd.sample(range(30), rnd.randint(1, 8))) for i in range(40)}
    sets[40] = []
    df = spark.createDataFrame([(i, s) for i, s in sets.items()], "id long, vector array<long>")
    got = {(a, b, round(d, 8)) for a, b, d in K.knn_self(df, 3, "jaccard", block_size=9).collect()}
    assert got == brute(sets, 3, "jaccard")


@pytest.mark.parametrize("family", ["signRP", "scalarRP"])
def test_lsh_distances_exact_and_recall(spark, family):
    rnd = np.random.default_rng(1)
    centers = rnd.normal(size=(5, 8)) * 5
    vecs = {i: [float(x) for x in centers[i % 5] + rnd.normal(size=8) * 0.3] for i in range(100)}
    df = spark.createDataFrame([(i, v) for i, v in vecs.items()], "id long, vector array<double>")
    metric = "cosine" if family == "signRP" else "l2"
    fam = H.HashFamily(family, 8, num_hashes=48, signature_length=4, bucket_width=4.0, seed=3)
    got = H.lsh_self(df, 5, fam, bucket_limit=16).collect()
    exact = brute(vecs, 5, metric)
    ex = {(a, b): d for a, b, d in exact}
    for a, b, d in got:
        x, y = np.array(vecs[a]), np.array(vecs[b])
        e = (1 - abs(x @ y) / np.linalg.norm(x) / np.linalg.norm(y)) if metric == "cosine" else np.linalg.norm(x - y)
        assert d == pytest.approx(e, abs=1e-9)
    per = {}
    for a, b, _ in got:
        per.setdefault(a, set()).add(b)
    assert all(len(v) <= 5 for v in per.values())
    recall = sum((a, b) in ex for a, b, _ in got) / len(ex)
    assert recall > 0.5


def test_lsh_query_deduplicates(spark, vec_df):
    vecs, df = vec_df
    fam = H.HashFamily("signRP", 6, num_hashes=32, signature_length=2, seed=9)
    r = H.lsh_query(vecs[3], df, 5, fam).collect()
    assert len({x["id"] for x in r}) == len(r) <= 5
    assert r[0]["id"] == 3 and r[0]["distance"] == pytest.approx(0.0, abs=1e-12)


def test_minhash_family_long_arithmetic():
    fam = H.HashFamily("minhash", 0, num_hashes=8, signature_length=2, seed=1)
    keys = fam.band_keys([[0, 5, 2**31 - 5], [0, 5, 2**31 - 5], [1, 2]])
    assert keys.shape == (3, 4) and keys.dtype == np.int64
    assert (keys[0] == keys[1]).all() and (keys[0] != keys[2]).any()


def test_corpus_steps(spark):
    sents = [(1, ["a", "b", "a", "c", "a", "zz"]), (2, ["b", "a", "c"]), (3, [])]
    df = spark.createDataFrame(sents, "sid long, tokens array<string>")
    v = C.build_vocab(df, "tokens", 2)
    assert rows(v, "word", "cn", "idx") == [("a", 4, 0), ("b", 2, 1), ("c", 2, 2)]
    enc = C.encode_sentences(df, v, "tokens", "sid", max_len=2)
    assert rows(enc, "sid", "chunk", "pos", "word") == [
        (1, 0, 1, "a"), (1, 0, 2, "b"), (1, 1, 3, "a"), (1, 1, 4, "c"), (1, 2, 5, "a"),
        (2, 0, 1, "b"), (2, 0, 2, "a"), (2, 1, 3, "c")]
    assert C.subsample(enc, v, 0.0) is enc
    pairs = C.context_pairs(enc, 1)
    assert rows(pairs, "sid", "pos", "centre", "context") == [
        (1, 1, 0, 1), (1, 2, 1, 0), (1, 3, 0, 2), (1, 4, 2, 0), (2, 1, 1, 0), (2, 2, 0, 1)]
    ns = C.negative_samples(pairs, C.noise_distribution(v), 4)
    assert ns.filter(F.col("negative") == F.col("centre")).count() == 0


def test_huffman_codes_prefix_free():
    codes, points = E.huffman_codes(np.array([50, 20, 10, 10, 5, 1]))
    strs = ["".join(map(str, c)) for c in codes]
    assert all(not b.startswith(a) for a in strs for b in strs if a != b)
    assert len(codes[0]) <= len(codes[-1])
    assert all(0 <= p < 5 for ps in points for p in ps)


def test_fit_embeddings_learns_and_is_deterministic(spark):
    rnd = random.Random(4)
    groups = [[f"a{i}" for i in range(6)], [f"b{i}" for i in range(6)]]
    sents = [(s, [rnd.choice(groups[s % 2]) for _ in range(30)]) for s in range(80)]
    df = spark.createDataFrame(sents, "sid long, tokens array<string>")
    kw = dict(vector_size=12, window=3, min_count=1, max_iter=4, negative=4, hs=0, num_partitions=3,
              step_size=0.05, seed=11)
    m1 = E.fit_embeddings(df, "tokens", "sid", **kw)
    m2 = E.fit_embeddings(df, "tokens", "sid", **kw)
    assert m1.losses[-1] < m1.losses[0]
    v1 = {w: np.array(v) for w, v in m1.embedding_table().collect()}
    v2 = {w: np.array(v) for w, v in m2.embedding_table().collect()}
    assert all(np.allclose(v1[w], v2[w]) for w in v1)
    cos = lambda x, y: x @ y / np.linalg.norm(x) / np.linalg.norm(y)
    same = np.mean([cos(v1[f"a{i}"], v1[f"a{j}"]) for i in range(6) for j in range(6) if i != j])
    cross = np.mean([cos(v1[f"a{i}"], v1[f"b{j}"]) for i in range(6) for j in range(6)])
    assert same > cross
    cb = E.fit_embeddings(df, "tokens", "sid", vector_size=8, window=2, min_count=1, max_iter=2, hs=1, cbow=1,
                          num_partitions=2, seed=3)
    assert cb.losses[-1] < cb.losses[0]


def test_fit_embeddings_parameter_checks(spark):
    df = spark.createDataFrame([(1, ["a"])], "sid long, tokens array<string>")
    with pytest.raises(ValueError):
        E.fit_embeddings(df, "tokens", negative=0, hs=0)
    with pytest.raises(ValueError):
        E.fit_embeddings(df, "tokens", min_count=5, negative=2, hs=0)


def test_synonyms_and_sentence_vectors(spark):
    emb = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.9, 0.1]), ("c", [-1.0, 0.0]), ("z", [0.0, 0.0])],
                                "word string, vector array<double>")
    syn = E.find_synonyms(emb, "a", 2).collect()
    assert [r["word"] for r in syn] == ["b", "z"]             # signed cosine, word excluded
    s = spark.createDataFrame([(1, ["a", "c", "unknown", "a"]), (2, [])], "id long, tokens array<string>")
    out = {r["id"]: r["embedding"] for r in E.embed_sentences(s, "tokens", emb, "id", 2).collect()}
    assert out[1] == pytest.approx([0.25, 0.0]) and out[2] == [0.0, 0.0]


def test_samples_and_features(spark):
    df = spark.range(0, 2000).select(F.col("id").cast("string").alias("k"))
    shards = [set(r["k"] for r in I.shard(df, "k", 4, i).collect()) for i in range(4)]
    assert sum(len(s) for s in shards) == 2000 and len(set.union(*shards)) == 2000
    ages = spark.createDataFrame([(None,), (10,), (18,), (24,), (25,), (80,), (99,)], "age int")
    assert [r[0] for r in ages.select(I.bucketize("age")).collect()] == [0, 0, 1, 1, 2, 7, 7]
    sz = I.embedding_sizes(spark.range(0, 100).select((F.col("id") % 16).alias("c")), ["c"]).first()
    assert sz["cardinality"] == 16 and sz["embedding_size"] == 2
    assert I.repeat(df, 3).count() == 6000


def test_listwise_and_padding(spark):
    # view v1 shows four items, v2 one, v3 two without any relevance; positions arrive out of order
    shown = [("v1", "bo", 41, "f", f"p{i}", [f"h{j}" for j in range(i)], 3 - i, i) for i in (2, 0, 3, 1)]
    shown += [("v2", "al", 19, "m", "q", ["h8", "h9"], 4, 0), ("v3", "cy", 60, "f", "r", [], 0, 0), ("v3", "cy", 60, "f", "s", ["r"], 0, 1)]
    pv = spark.createDataFrame(shown, "pv_id string, user_id string, age long, gender string, item_id string, "
                               "clicked_items_15d array<string>, relevance long, position long")
    lw = I.listwise_samples(pv, "pv_id", "position")
    got = {r["pv_id"]: r for r in lw.collect()}
    assert set(got) == {"v1", "v2"}  # a view without relevance is dropped
    assert got["v1"]["relevance"] == [3, 2, 1, 0] and got["v1"]["item_id"] == ["p0", "p1", "p2", "p3"]
    assert got["v1"]["clicked_items_15d"] == [[], ["h0"], ["h0", "h1"], ["h0", "h1", "h2"]]
    assert (got["v2"]["user_id"], got["v2"]["age"], got["v2"]["gender"]) == ("al", 19, "m")
    b = {r["pv_id"]: r for r in I.padded_batches(lw, 2, ["pv_id"], {"relevance": I.RELEVANCE_PAD, "item_id": I.STRING_PAD},
                                                 {"clicked_items_15d": I.STRING_PAD}).collect()}
    assert set(b) == {"v1", "v2"}
    for r in b.values():
        assert len(r["relevance"]) == len(r["item_id"]) == len(r["clicked_items_15d"]) == 4
        assert {len(h) for h in r["clicked_items_15d"]} == {3}
    assert b["v2"]["relevance"][1:] == [I.RELEVANCE_PAD] * 3 and b["v2"]["item_id"][1:] == ["0"] * 3
    assert b["v2"]["clicked_items_15d"][0] == ["h8", "h9", "0"]
    assert I.expand_request(lw.select("pv_id", "item_id"), "item_id").count() == 5
    m = I.dense_mask(spark.createDataFrame([(1, None), (2, ["x", "0"])], "id long, h array<string>"), "h")
    assert rows(m, "id", "h", "h_mask") == [(1, ["0"], [False]), (2, ["x", "0"], [True, False])]


def test_click_history_brute_force(spark):
    samples = spark.createDataFrame([(1, "u", "2024-01-20 12:00:00"), (2, "u", "2024-01-02 00:00:00"),
                                     (3, "v", "2024-01-10 00:00:00")], "sample_id long, user string, ts string") \
        .withColumn("ts", F.to_timestamp("ts"))
    log = spark.createDataFrame([("u", "a", "2024-01-05 12:00:00"), ("u", "b", "2024-01-20 11:59:59"),
                                 ("u", "c", "2024-01-20 12:00:00"), ("u", "d", "2024-01-05 11:59:59"),
                                 ("v", "e", "2024-01-01 00:00:00")], "user string, item string, ts string") \
        .withColumn("ts", F.to_timestamp("ts"))
    h = {r["sample_id"]: r["history"] for r in I.click_history(samples, log, 15).collect()}
    assert h == {1: ["a", "b"], 2: [], 3: ["e"]}


def test_sources_round_trip(spark, tmp_path):
    nb = spark.createDataFrame([(1, 2, 0.5), (2, 1, 0.5)], "itemId long, candidateId long, distance double")
    IO.write_neighbors(nb, str(tmp_path / "nn"), n_files=2)
    back = spark.read.parquet(str(tmp_path / "nn"))
    assert back.schema == IO.NEIGHBOR_SCHEMA or [f.name for f in back.schema] == ["itemId", "candidateId", "distance"]
    assert back.count() == 2
    emb = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0])], "word string, vector array<double>")
    IO.save_embeddings(emb, str(tmp_path / "emb"))
    assert IO.load_embeddings(spark, str(tmp_path / "emb")).count() == 2
    s = spark.createDataFrame([(1, "u", 3, "f", "i", ["x"])], I.POINTWISE_SCHEMA)
    IO.write_samples(s, I.POINTWISE_SCHEMA, str(tmp_path / "smp"), 1)
    assert IO.read_samples(spark, str(tmp_path / "smp"), I.POINTWISE_SCHEMA).count() == 1
    with pytest.raises(ValueError):
        IO.write_samples(s.drop("age"), I.POINTWISE_SCHEMA, str(tmp_path / "bad"))
    bag = spark.createDataFrame([(1, [("w", "x", 1.0), ("w", "x", 2.0), ("w", "nope", 5.0)]), (2, [])],
                                "id long, attributes array<struct<name:string,term:string,value:double>>")
    idx = IO.feature_index(spark.createDataFrame([("w\tx",), ("w\ty",)], "key string"), "key")
    v = {r["id"]: (r["indices"], r["values"], r["n_features"]) for r in IO.vectorize_bag(bag, "id", "attributes", idx).collect()}
    assert v[1] == ([0], [3.0], 2) and v[2] == ([], [], 2)
    t = IO.read_transactions(spark.createDataFrame([(" a  b a c ",)], "items string"), "items")
    assert sorted(t.first()["items"]) == ["a", "b", "c"]


def test_pool_embedding_mean_and_empty(spark):
    emb = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 2.0])], "id long, vector array<double>")
    df = spark.createDataFrame([(10, [1, 2, 2]), (11, []), (12, [7])], "rid long, items array<long>")
    got = {r["rid"]: r["pooled"] for r in I.pool_embedding(df, "rid", "items", emb, 2).collect()}
    assert got[10] == pytest.approx([1 / 3, 4 / 3]) and got[11] == [0.0, 0.0] and got[12] == [0.0, 0.0]


def test_pair_rules_without_transaction_ids(spark):
    from tessera.operators import rules
    tx = ["a b c", "a b", "a c", "b c d", "a b d", "a", "b c", "a b c d", "c d", "a d"] * 2
    df = spark.createDataFrame([(t,) for t in tx], "items string")
    t = IO.read_transactions(df, "items")
    with_ids = IO.read_transactions(spark.createDataFrame(list(enumerate(tx)), "tid long, items string"), "items")
    a = rows(rules.pair_rules(t, "items", 3, 0.1, 10))
    b = rows(rules.pair_rules(with_ids, "items", 3, 0.1, 10, tid="tid"))
    assert a == b and len(a) > 0


def test_nearest_neighbors_dispatch_and_checks(spark, vec_df):
    vecs, df = vec_df
    brute = H.nearest_neighbors(df, None, 3, "brute", metric="Cosine")
    assert brute.count() == 61 * 3            # zero vector excluded
    with pytest.raises(ValueError):
        H.nearest_neighbors(df, None, 3, "brute")              # metric required
    with pytest.raises(ValueError):
        H.nearest_neighbors(df, None, 3, "signRP")             # seed required
    with pytest.raises(ValueError):
        H.nearest_neighbors(df, None, 3, "kdtree", seed=1)     # unknown algorithm
    lsh = H.nearest_neighbors(df, df, 3, "signRP", num_hashes=32, signature_length=4, seed=2)
    assert lsh.groupBy("src").count().agg(F.max("count")).first()[0] <= 3
    with pytest.raises(ValueError):
        H.HashFamily("signRP", 6, num_hashes=8, signature_length=16, seed=1)


def test_knn_query_jaccard_and_minhash_query(spark):
    sets = {i: sorted({i % 7, (i * 3) % 11, 20 + i % 5}) for i in range(50)}
    df = spark.createDataFrame([(i, s) for i, s in sets.items()], "id long, vector array<long>")
    q = sets[4]
    exact = K.knn_query(q, df, 5, "jaccard").collect()
    assert exact[0]["distance"] == pytest.approx(0.0)
    want = sorted((round(1 - len(set(q) & set(s)) / len(set(q) | set(s)), 10), i) for i, s in sets.items())[:5]
    assert [(round(r["distance"], 10), r["id"]) for r in exact] == want
    fam = H.HashFamily("minhash", 0, num_hashes=20, signature_length=2, seed=4)
    approx = H.lsh_query(q, df, 5, fam).collect()
    assert approx[0]["id"] in {i for i, s in sets.items() if s == q}


def test_feature_helpers(spark):
    df = spark.createDataFrame([(1, "a", [1.0, 2.0], ["x", "y"])], "id long, k string, v array<double>, items array<string>")
    emb = spark.createDataFrame([("a", [0.5, 0.5])], "id string, vector array<double>")
    got = I.lookup_embedding(df, "k", emb).first()
    assert got["k_emb"] == [0.5, 0.5]
    assert I.assemble_features(I.lookup_embedding(df, "k", emb), ["v", "k_emb"]).first()["features"] == [1.0, 2.0, 0.5, 0.5]
    ex = rows(I.expand_request(df.select("id", "items"), "items"), "id", "slot", "item_id")
    assert ex == [(1, 0, "x"), (1, 1, "y")]
    assert I.hash_bucket(F.lit("abc"), 10) is not None
    hb = spark.range(0, 500).select(I.hash_bucket(F.col("id").cast("string"), 7).alias("b")).distinct().count()
    assert hb == 7


def test_save_table_overwrites(spark):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    IO.save_table(df, "tessera_test_table")
    IO.save_table(df.union(df), "tessera_test_table")
    assert spark.table("tessera_test_table").count() == 2
    spark.sql("DROP TABLE tessera_test_table")


def test_knn_string_ids(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(30, 4)).tolist()
    num = spark.createDataFrame([(i, x) for i, x in enumerate(v)], "id long, vector array<double>")
    txt = spark.createDataFrame([(f"k{i:02d}", x) for i, x in enumerate(v)], "id string, vector array<double>")
    want = [(f"k{a:02d}", f"k{b:02d}", pytest.approx(d)) for a, b, d in rows(K.knn_self(num, 3))]
    assert rows(K.knn_self(txt, 3)) == want


def test_absent_list_features(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, None)], "id long, x array<string>")
    out = {r["id"]: r for r in I.padded_batches(df, 2, ["id"], {"x": "0"}).collect()}
    assert out[2]["x"] == ["0", "0"]
    b = {r["id"]: r["b"] for r in df.select("id", I.hash_buckets("x", 9).alias("b")).collect()}
    assert b[2] == [] and len(b[1]) == 2 and all(0 <= i < 9 for i in b[1])


def test_lsh_of_an_empty_source(spark):
    empty = spark.createDataFrame([], "id long, vector array<double>")
    assert H.nearest_neighbors(empty, k=2, seed=1).count() == 0


# --- pivot partitions, first common band, ids of any type ---------------------------------------------------------------

def clustered(n, dim=6, centres=8, seed=3):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(centres, dim)) * 20
    return [(f"k{i:04d}", (c[i % centres] + rng.normal(size=dim)).tolist()) for i in range(n)]


def brute_nn(src, pool, k, dist):
    out = set()
    for a, x in src:
        near = sorted((float(round(dist(x, y), 9)), b) for b, y in pool if a != b and dist(x, y) is not None)[:k]
        out |= {(a, b, d) for d, b in near}
    return out


def l2(x, y):
    return float(np.linalg.norm(np.array(x) - np.array(y)))


def jaccard(x, y):
    x, y = set(x or ()), set(y or ())
    return 1 - len(x & y) / len(x | y) if x and y else None


@pytest.mark.parametrize("metric", ["l2", "cosine"])
@pytest.mark.parametrize("block", [16, 64, 500])
def test_pivot_blocks_give_all_pairs_result(spark, metric, block):
    data = clustered(300)
    df = spark.createDataFrame(data, "id string, vector array<double>")

    def cos(x, y):
        x, y = np.array(x), np.array(y)
        return 1 - abs(float(x @ y)) / float(np.linalg.norm(x) * np.linalg.norm(y))
    dist = l2 if metric == "l2" else cos
    got = {(a, b, round(d, 9)) for a, b, d in K.knn_self(df, 3, metric, block_size=block).collect()}
    assert {g[:2] for g in got} == {g[:2] for g in brute_nn(data, data, 3, dist)}
    src = df.where("id < 'k0100'")
    got = {(a, b) for a, b, _ in K.knn_join(src, df, 4, metric, block_size=block).collect()}
    assert got == {g[:2] for g in brute_nn(data[:100], data, 4, dist)}


def test_far_block_pairs_are_skipped(spark, tmp_path):
    """Eight far clusters: most of the block pairs have bounds beyond the radii, and none with a neighbour is left out."""
    df = spark.createDataFrame(clustered(640), "id string, vector array<double>")
    pivots = K.choose_pivots(df.select("id", F.col("vector").alias("v")), "l2", 8)
    blocks = K.make_blocks(df.select("id", F.col("vector").alias("v")), "l2", pivots, 640, 20).cache()
    n = blocks.count()
    met = blocks.select("blk", "lo", "hi", F.col("blk").alias("seed"), F.lit(6.0).alias("radius"))
    pairs = K.surviving_pairs(met, met, "l2", True).collect()
    assert n >= 32 and 0 < len(pairs) < n * (n - 1) / 2 / 4
    x = {r["blk"]: np.frombuffer(r["data"]).reshape(len(r["ids"]), -1) for r in blocks.collect()}
    kept = {tuple(r) for r in pairs}
    for a in x:
        for b in x:
            if a < b and (a, b) not in kept:
                assert np.linalg.norm(x[a][:, None] - x[b][None], axis=2).min() > 6.0
    blocks.unpersist()


def test_set_sizes_bound_jaccard(spark):
    rng = np.random.default_rng(4)
    data = [(i, sorted(set(rng.integers(0, 60 if i % 2 else 3000, size=3 if i % 2 else 400).tolist()))) for i in range(120)] + [(500, []), (501, None)]
    df = spark.createDataFrame(data, "id long, vector array<long>")
    want = brute_nn(data, data, 3, jaccard)
    for block in (10, 50, 1000):
        got = {(a, b, round(d, 9)) for a, b, d in K.knn_self(df, 3, "jaccard", block_size=block).collect()}
        assert got == want
    lo = np.array([[np.log(2)], [np.log(300)]])
    hi = np.array([[np.log(3)], [np.log(400)]])
    assert K.bounds("jaccard", lo, hi, lo, hi)[0, 1] > 0.98


def test_many_equal_vectors_and_ids(spark):
    """A third of all rows are one vector: ties go by id, equal ids are never neighbours."""
    data = [(i % 200, [1.0, 0.0] if i % 3 == 0 else [float(i), 1.0]) for i in range(300)]
    df = spark.createDataFrame(data, "id long, vector array<double>")
    got = K.knn_self(df, 2, "l2", block_size=25).collect()
    assert all(r["src"] != r["cand"] for r in got)
    ties = sorted(r["cand"] for r in got if r["src"] == 150 and r["distance"] == 0.0)
    assert ties == [0, 1]  # id 1 has the vector of row 201


def test_no_items(spark):
    df = spark.createDataFrame([("a", [1.0])], "id string, vector array<double>")
    for metric in ("l2", "cosine"):
        assert K.knn_self(df.limit(0), 2, metric).count() == 0
        assert K.knn_join(df, df.limit(0), 2, metric).count() == 0
        assert K.knn_self(df, 2, metric).count() == 0


@pytest.mark.parametrize("family", ["signRP", "scalarRP", "minhash"])
def test_lsh_pairs_are_found_once_and_ids_may_be_strings(spark, family):
    rng = np.random.default_rng(5)
    if family == "minhash":
        data = [(f"k{i:04d}", sorted(set(rng.integers(0, 25, size=8).tolist()))) for i in range(80)]
        df = spark.createDataFrame(data, "id string, vector array<long>")
        dist, fam = jaccard, H.HashFamily(family, 0, 24, 2, seed=3)
    else:
        data = clustered(80, centres=10)
        df = spark.createDataFrame(data, "id string, vector array<double>")
        fam = H.HashFamily(family, 6, 24, 2, 30.0, seed=3)

        def dist(x, y):
            x, y = np.array(x), np.array(y)
            return l2(x, y) if family == "scalarRP" else 1 - abs(float(x @ y)) / float(np.linalg.norm(x) * np.linalg.norm(y))
    keys = fam.band_keys([v for _, v in data])
    want = {}
    for i, (a, x) in enumerate(data):
        near = sorted((round(dist(x, y), 8), b) for j, (b, y) in enumerate(data) if a != b and (keys[i] == keys[j]).any())[:4]
        want[a] = [b for _, b in near]
    for limit in (7, 1000):
        raw = H.lsh_self(df, 4, fam, bucket_limit=limit).collect()
        assert len({(r["src"], r["cand"]) for r in raw}) == len(raw)
        got = {}
        for r in sorted(raw, key=lambda r: (r["src"], round(r["distance"], 8), r["cand"])):
            got.setdefault(r["src"], []).append(r["cand"])
        assert got == {a: b for a, b in want.items() if b}
    other = {(r["src"], r["cand"]) for r in H.lsh_join(df.where("id < 'k0030'"), df.where("id >= 'k0030'"), 100, fam, bucket_limit=9).collect()}
    assert other == {(a, b) for i, (a, _) in enumerate(data) for j, (b, _) in enumerate(data) if a < "k0030" <= b and (keys[i] == keys[j]).any()}
    q = H.lsh_query(data[0][1], df, 3, fam).collect()
    assert q[0]["id"] == "k0000" and isinstance(q[0]["id"], str)


def test_lsh_join_has_no_dedupe_shuffle(spark, capsys):
    df = spark.createDataFrame(clustered(40), "id string, vector array<double>")
    H.lsh_self(df, 2, H.HashFamily("signRP", 6, 8, 2, seed=1)).explain()
    plan = capsys.readouterr().out
    after = plan[:plan.index("MapInPandas")]  # printed from the top: what comes after the kernel
    assert after.count("Exchange") == 1 and "Aggregate" not in after


# --- skip-gram on a partitioned model --------------------------------------------------------------------------------------

def numpy_sgns(examples, n_words, dim, steps, rate, per_word, first):
    a, b = first.copy(), np.zeros((n_words, dim))
    losses = []
    for _ in range(steps):
        ga, gb, na, nb = np.zeros_like(a), np.zeros_like(b), np.zeros(n_words), np.zeros(n_words)
        loss = total = 0
        for c, t, label, n in examples:
            z = a[c] @ b[t]
            g = rate * n * (label - 1 / (1 + math.exp(-z)))
            ga[c] += g * b[t]
            gb[t] += g * a[c]
            na[c] += n
            nb[t] += n
            loss += n * math.log1p(math.exp(-z if label else z))
            total += n
        losses.append(loss / total)
        a += ga / np.maximum(1, na / per_word)[:, None]
        b += gb / np.maximum(1, nb / per_word)[:, None]
    return a, losses


def test_partitioned_steps_match_numpy(spark):
    rng = random.Random(7)
    ex = {(rng.randrange(8), rng.randrange(8), rng.randrange(2)): rng.choice([1, 2, 40]) for _ in range(60)}
    ex = [(*k, n) for k, n in ex.items()]
    vocab = spark.createDataFrame([(f"w{i}", i) for i in range(9)], "word string, idx long")  # one word has no examples
    df = spark.createDataFrame(ex, "centre long, target long, label int, n long")
    start = S.fit_partitioned(df.limit(0), vocab, 3, 4)
    first = np.zeros((9, 3))
    for r in start.centre.collect():
        first[r["idx"]] = r["vec"]
    assert start.losses == [] and len({tuple(v) for v in first}) == 9 and np.abs(first).max() <= 0.5 / 3
    m = S.fit_partitioned(df, vocab, 3, 4, rate=0.7, per_word=5)
    want, losses = numpy_sgns(ex, 9, 3, 4, 0.7, 5, first)
    for r in m.embedding_table().collect():
        assert np.allclose(r["vector"], want[int(r["word"][1:])], atol=1e-12)
    assert np.allclose(m.losses, losses) and losses[-1] < losses[0]


def test_partitioned_training_separates_topics(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice("abcd" if i % 2 else "wxyz") for _ in range(12)]) for i in range(150)]
    df = spark.createDataFrame(rows, "sid long, tokens array<string>")
    vocab = C.build_vocab(df, "tokens", 1)
    pairs = C.context_pairs(C.encode_sentences(df, vocab, "tokens", "sid"), 3)
    m = S.fit_partitioned(S.training_examples(pairs, C.noise_distribution(vocab), 3), vocab, 6, 8, rate=0.2, per_word=20)
    assert all(x > y for x, y in zip(m.losses, m.losses[1:]))
    v = {r["word"]: np.array(r["vector"]) / np.linalg.norm(r["vector"]) for r in m.embedding_table().collect()}
    same = np.mean([v[a] @ v[b] for a in "abcd" for b in "abcd" if a != b])
    other = np.mean([v[a] @ v[b] for a in "abcd" for b in "wxyz"])
    assert same > other + 0.5


def test_partitioned_model_is_not_collected():
    import inspect
    text = inspect.getsource(S)
    assert not any(word in text for word in ("toPandas", "collect(", "broadcast("))
