"""Tests of the fourth round's findings; every test builds its own rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import corpus as C
from tessera.operators import knn as K
from tessera.operators import lsh as H


def test_subsample_of_bounded_chunks_gives_the_same_rows_and_writes_none(spark, monkeypatch):
    df = spark.createDataFrame([(s, ["a", "b", "c", "d", "x", None][: 2 + s % 5] * 9) for s in range(20)], "sid long, tokens array<string>")
    vocab = C.build_vocab(df, "tokens", 30).cache()
    rows = lambda d: sorted(tuple(r) for r in d.collect())
    encoded = C.encode_sentences(df, vocab, max_len=7).cache()
    want, wrote, write = rows(C.subsample(encoded, vocab, 0.01)), [], C.written
    monkeypatch.setattr(C, "written", lambda d: wrote.append(1) or write(d))
    assert rows(C.subsample(encoded, vocab, 0.01, max_len=7)) == want and not wrote
    monkeypatch.setattr(C, "FREQUENT", 2)  # the other words are found by a shuffle
    assert rows(C.encode_sentences(df, vocab, max_len=7)) == rows(encoded)


def test_packed_sets_take_two_bytes_for_a_frequent_element():
    table = np.array([-5, 0, 3, 1 << 51], "int64")
    sets = [[1 << 51, 7, 3], [-5], [(1 << 62) + 1, 65535, 0], [8, 9]]
    data, sizes = K.pack("jaccard", sets, table)
    assert len(data) == 2 * 5 - 2 + 8 * 5 and len(sizes) == 8 * len(sets)
    for codes, packed in ((table, (data, sizes)), (K.NO_CODES, K.pack("jaccard", sets))):
        p = K.Pack("jaccard", *packed, codes)
        cut = np.split(p.elems, np.cumsum(p.sizes)[:-1])
        assert [sorted(x.tolist()) for x in cut] == [sorted(s) for s in sets]


def _sets(spark):
    rng = np.random.default_rng(4)
    rows = [(i, sorted({int(x) << 40 for x in rng.zipf(1.3, 12) % 5000})) for i in range(90)]
    return dict(rows), spark.createDataFrame(rows + [(200, []), (201, None)], "id long, vector array<long>")


@pytest.mark.parametrize("coded", [0, 3, 1 << 16])
def test_neighbours_of_sets_do_not_depend_on_the_codes(spark, monkeypatch, coded):
    monkeypatch.setattr(K, "CODED", coded)
    sets, df = _sets(spark)

    def best(src, ok):
        far = lambda a, b: 1 - len(set(a) & set(b)) / len(set(a) | set(b))
        return sorted((round(far(sets[src], v), 9), c) for c, v in sets.items() if c != src and ok(src, c))[:3]

    got = {}
    for r in K.knn_self(df, 3, "jaccard", block_size=16).collect():
        got.setdefault(r["src"], []).append((round(r["distance"], 9), r["cand"]))
    assert {s: sorted(x) for s, x in got.items()} == {s: best(s, lambda a, b: True) for s in sets}
    fam = H.HashFamily("minhash", 0, num_hashes=8, signature_length=1, seed=3)
    keys = dict(zip(sets, fam.band_keys(list(sets.values()))))
    want = {s: x for s in sets if (x := best(s, lambda a, b: (keys[a] == keys[b]).any()))}
    for all_pairs in (0, 1 << 40):
        monkeypatch.setattr(H, "ALL_PAIRS", all_pairs)
        got = {}
        for r in H.lsh_self(df, 3, fam, bucket_limit=4).collect():
            got.setdefault(r["src"], []).append((round(r["distance"], 9), r["cand"]))
        assert {s: sorted(x) for s, x in got.items()} == want


def test_pool_items_look_for_nothing(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(60)], "id long, vector array<double>")
    got = K.knn_join(df.where("id < 20"), df, 3, "l2", block_size=8).collect()
    assert {r["src"] for r in got} == set(range(20)) and len(got) == 60


@pytest.mark.parametrize("task_pairs,block", [(2_000_000, 512), (20, 4)])
def test_item_cf_in_shares_gives_the_same_rows(spark, monkeypatch, task_pairs, block):
    from tessera.operators import cf, pairs
    monkeypatch.setattr(pairs, "TASK_PAIRS", task_pairs)
    monkeypatch.setattr(pairs, "MAX_HOT", 5)
    data = [(u, i, float((u * i) % 5)) for u in range(12) for i in range(14) if (u + i) % 3 or i == 0]
    df = spark.createDataFrame(data + [(1, None, 2.0), (None, 3, 1.0)], "user long, item long, rating double")
    rows = lambda d: sorted((r["item1"], r["item2"], round(r["sim"], 9)) for r in d.collect())
    want = rows(cf.item_cf(df, top=3, block_size=block))
    shares, split = [], cf.pair_shares
    monkeypatch.setattr(pairs, "SHARE_PAIRS", 200)
    monkeypatch.setattr(cf, "pair_shares", lambda *a, **k: shares.extend(split(*a, **k)) or shares)
    assert rows(cf.item_cf(df, top=3, block_size=block)) == want and len(shares) > 3 and want


@pytest.mark.parametrize("parts", [None, 1, 4])
def test_itemsets_and_rules_come_without_a_list_on_the_driver(spark, parts):
    from itertools import combinations

    from tessera.operators import rules
    data = [[f"i{(t * j) % 7}" for j in range(1, 2 + t % 5)] for t in range(40)] + [[], None]
    df = spark.createDataFrame([(x,) for x in data], "items array<string>")
    held = [set(x) for x in data if x is not None]
    count = lambda s: sum(set(s) <= x for x in held)
    names = sorted(set().union(*held))
    want = {c: count(c) for k in range(1, 6) for c in combinations(names, k) if count(c) >= 4}
    sets = rules.frequent_itemsets(df, "items", 4, parts)
    got = [(tuple(sorted(r["items"])), r["freq"]) for r in sets.collect()]
    assert dict(got) == want and len(got) == len(want)
    found = {(tuple(sorted(r["antecedent"])), *r["consequent"]): (round(r["confidence"], 9), round(r["lift"], 9))
             for r in rules.association_rules(df, "items", 4, 0.3, parts).collect()}
    conf = {(tuple(x for x in s if x != c), c): n / want[tuple(x for x in s if x != c)] for s, n in want.items() if len(s) > 1 for c in s}
    assert found == {k: (round(v, 9), round(v / (want[k[1],] / len(held)), 9)) for k, v in conf.items() if v >= 0.3}
