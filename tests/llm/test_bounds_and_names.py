"""Columns with any names, sources without a cap, derived sketch shares, letters, underflow, schedules and messages against brute force."""
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language_id, mixing, near_dedup, pii, stages

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
OWN_NAMES = ["id", "score", "lang_pred", "mix_weight", "mix_pos", "mix_block", "on_target", "kept", "component_id", "n_shingles", "set", "rep",
             "label", "k1", "k2", "c0", "h", "w", "g", "v", "s", "n", "__id", "__text", "__s", "__p", "r"]


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, src, len(t or "")) for i, t, lang, src in rows], SCHEMA)


def clashing(df):
    return df.select("*", *[F.lit(f"clash {n}").alias(n) for n in OWN_NAMES])


@pytest.fixture(scope="module")
def some(spark):
    rng = random.Random(3)
    text = {"en": "the cat and the dog went over a hill with their friends", "de": "der hund und die katze gingen weit über den berg"}
    rows = []
    for i in range(60):
        lang = rng.choice(["en", "de"])
        words = text[lang].split() * 3
        rng.shuffle(words)
        rows.append((i, " ".join(words), lang, f"s{i % 3}"))
    rows += [(100, rows[0][1], "en", "s0"), (101, None, None, None), (102, "", None, "s1"), (103, "123 !", None, "s1")]
    return documents(spark, rows)


def test_near_dedup_with_any_columns(some):
    want = sorted(map(str, near_dedup.near_dedup(some).collect()))
    assert sorted(map(str, near_dedup.near_dedup(clashing(some)).collect())) == want


def test_mix_with_any_columns(some):
    want = mixing.mix(some).toPandas().sort_values("mix_pos")
    got = mixing.mix(clashing(some)).toPandas().sort_values("mix_pos")
    assert list(got["mix_pos"]) == list(want["mix_pos"]) and list(got["mix_weight"]) == list(want["mix_weight"])
    assert list(got["id"]) == ["clash id"] * len(want)


def test_language_with_any_columns(some):
    model = language_id.train(some)
    want = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in model.predict(some).collect()}
    other = language_id.train(clashing(some)).predict(clashing(some))
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in other.collect()} == want


def test_stages_with_any_columns(some, tmp_path):
    named = clashing(some)
    for stage in (stages.language_id, stages.line_dedup, stages.near_dedup):
        plain, out = stage(some.sparkSession, some, None), stage(some.sparkSession, named, None)
        assert out.columns == named.columns
        assert sorted(r["doc_id"] for r in out.collect()) == sorted(r["doc_id"] for r in plain.collect())
        assert {r["score"] for r in out.collect()} == {"clash score"}
    assert stages.mix_sources(some.sparkSession, named, None).count() == some.count()


def test_more_sources_than_weights(spark):
    docs = spark.range(0, 12_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.concat(F.lit("site"), F.col("id") % 5000).alias("source"))
    out = mixing.mix(docs).toPandas()
    assert len(out) == 12_000 and out["mix_pos"].is_unique and out["source"].nunique() == 5000
    assert out["mix_weight"].min() >= 1
    assert (out["mix_release"] <= out["mix_slot"]).all() and (out["mix_slot"] < out["mix_deadline"]).all()


def plain_edf(weights):
    """Every slot looks at all sources."""
    total, done, out = sum(weights), [0] * len(weights), [[] for _ in weights]
    for t in range(total):
        ready = [(-(-(done[s] + 1) * total // w), s) for s, w in enumerate(weights) if done[s] < w and done[s] * total // w <= t]
        s = min(ready)[1]
        done[s] += 1
        out[s].append(t)
    return out


def test_schedule_is_earliest_deadline_first():
    rng = random.Random(4)
    for _ in range(100):
        weights = mixing.quantise([rng.random() ** 2 + 1e-6 for _ in range(rng.randrange(1, 20))], rng.choice([25, 60, 101]))
        assert mixing.period(weights) == plain_edf(weights)


def binomial_below(c, k, s):
    return sum(math.comb(k, i) * s ** i * (1 - s) ** (k - i) for i in range(c))


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 95])
@pytest.mark.parametrize("k", [16, 64, 128])
def test_share_follows_from_the_miss_probability(percent, k):
    for miss in (1e-3, 1e-6, 1e-9):
        c = math.ceil(k * near_dedup.least_share(percent, k, miss))
        assert binomial_below(c, k, percent / 100) <= miss < binomial_below(c + 1, k, percent / 100)
    assert near_dedup.least_share(percent, k, 0.0) == 0.0
    assert math.ceil(64 * near_dedup.least_share(85, 64, 1e-6)) == 39


@pytest.mark.parametrize("percent, miss", [(60, 1e-6), (85, 0.0)])
def test_near_dedup_at_other_thresholds(spark, percent, miss):
    rng = random.Random(5)
    base = [[f"w{rng.randrange(500)}" for _ in range(120)] for _ in range(6)]
    texts = []
    for b in base:
        for _ in range(8):
            t = list(b)
            for _ in range(rng.randrange(12)):
                t[rng.randrange(len(t))] = f"x{rng.randrange(500)}"
            texts.append(t)
    sets = [{tuple(t[i:i + 5]) for i in range(len(t) - 4)} for t in texts]
    root = list(range(len(sets)))
    for _ in range(len(sets)):
        for a, b in itertools.combinations(range(len(sets)), 2):
            if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[a] = root[b] = min(root[a], root[b])
    docs = documents(spark, [(i, " ".join(t), "en", "s") for i, t in enumerate(texts)])
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_dedup(docs, percent=percent, miss=miss).collect()}
    assert got == dict(enumerate(root)) and 6 < len(set(root)) < 48


def test_only_letters_are_letters(spark):
    docs = documents(spark, [(1, "²½", None, "s"), (2, "① ⅷ ㊿", None, "s"), (3, "123 _ !", None, "s"), (4, "́", None, "s")]
                     + [(10 + i, "der hund und die katze", "de", "s") for i in range(20)] + [(50 + i, "the dog and the cat", "en", "s") for i in range(20)]
                     + [(90, "²hund½katze", None, "s"), (91, "語", None, "s")])
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.train(docs).predict(docs).collect()}
    assert all(got[i] == "und" for i in (1, 2, 3, 4)) and got[90] == "de" and got[91] in ("de", "en")
    assert list(language_id.words_of("a²b½ c_d 7e Ⅷx")) == ["a", "b", "c", "d", "e", "x"]


def test_long_unseen_words_have_a_score():
    lattice = language_id.Lattice([c for c in "abcdefghij"])
    prob = np.full((10, 2), 1e-12)
    prob[0] = 1.0
    words = ["b" * language_id.LONGEST, "z" * language_id.LONGEST]
    scores = language_id.word_scores(words, lattice, prob, 1e-7)
    assert np.isfinite(scores).all()


def exact_marginals(field, g):
    u, n = field.unary[g.x].sum(axis=1), len(g.spans)
    total = np.zeros((n, pii.NONE + 1))
    for y in itertools.product(range(pii.NONE + 1), repeat=n):
        e = sum(u[i, y[i]] for i in range(n)) + sum(field.step[y[i], y[i + 1]] for i in g.chain)
        e += sum(field.skip for i, j in itertools.combinations(range(n), 2) if g.group[i] == g.group[j] and y[i] == y[j])
        for i in range(n):
            total[i, y[i]] += math.exp(e)
    return total / total.sum(axis=1, keepdims=True)


def test_skip_messages_are_exact_on_a_pair_and_close_on_loops():
    rng = np.random.default_rng(6)
    for text, tolerance in (("12 word 12", 1e-9), ("12 word 34 word 12", 1e-9), ("12 word 12 word 12", 0.12), ("12 34 word 34 12", 0.12)):
        for _ in range(20):
            field = pii.Field()
            field.unary[:] = rng.normal(size=field.unary.shape) * 0.5
            field.step[:] = rng.normal(size=field.step.shape) * 0.3
            field.skip = 0.7
            g = pii.Graph(text)
            assert np.abs(field.marginals(g, rounds=6) - exact_marginals(field, g)).max() < tolerance


def test_many_mentions_weigh_more_than_one():
    field = pii.Field()
    field.skip = 0.5
    field.unary[:] = 0.05 * np.eye(pii.NONE + 1)[2]
    few, many = (field.marginals(pii.Graph(" word ".join(["4539578763621486"] * n)))[0, 2] for n in (2, 50))
    assert many > few + 0.1
