"""The numbered operators against brute force on small tables: nulls, empty and long texts, ties, repeats, clashing columns."""
import collections
import hashlib
import itertools
import math
import random
import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import decontaminate, exact_dedup, language_id, license_scan, line_dedup, lm_score, mixing, near_dedup, pii, stages, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BLANKED = re.compile(r"[^\x20\x09-\x0D]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(ASCII)


def table(spark, texts, langs=None, sources=None):
    rows = [(i, t, (langs or {}).get(i), (sources or {}).get(i, "s"), len(t or "")) for i, t in texts]
    # columns whose names an operator might use itself
    return spark.createDataFrame(rows, SCHEMA).withColumn("text_sha256", F.lit(1)).withColumn("kept", F.lit(2)).withColumn("item", F.lit(3))


def words(rng, n, vocab=40):
    return " ".join(f"w{rng.randrange(vocab)}" for _ in range(n))


EDGE = [(0, None), (1, ""), (2, "  \n\t "), (3, "!!!"), (4, "One"), (5, "É é A a"), (6, "x" * 70_000), (7, "x " * 20_000)]


# --- 1 ---------------------------------------------------------------------------------------------------------------

def brute_contamination(docs, items, n=13):
    out = {}
    iw = [(str(i), ALNUM.findall(lower(t))) for i, t in items]
    wins = [(i, {tuple(w[j:j + min(n, len(w))]) for j in range(max(1, len(w) - n + 1))}) for i, w in iw if w]
    for d, t in docs:
        w, hit, found = ALNUM.findall(lower(t)), set(), set()
        for i, ws in wins:
            size = len(next(iter(ws)))
            for p in range(len(w) - size + 1):
                if tuple(w[p:p + size]) in ws:
                    found.add(i)
                    hit.update(range(p, p + size))
        ids = ",".join(sorted(found))
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("max_broadcast", [500_000, 0])
def test_contamination(spark, max_broadcast):
    rng = random.Random(1)
    items = [(i, words(rng, n, 400)) for i, n in enumerate([13, 14, 30, 60, 200, 5, 1, 12, 6])] + [(20, None), (21, "..."), (22, "w1 " * 30)]
    items.append((30, items[3][1]))  # an item twice
    docs = list(EDGE)
    for d in range(10, 60):
        parts = [words(rng, rng.randrange(0, 40), 400) for _ in range(3)]
        src = items[rng.randrange(6)][1].split()
        a = rng.randrange(len(src))
        parts.insert(1, " ".join(src[a:a + rng.choice([5, 12, 13, 14, 25])]).upper())
        docs.append((d, ", ".join(parts)))
    docs += [(70, items[2][1]), (71, "W1, " * 40), (72, items[6][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.contamination(table(spark, docs), bench, max_broadcast=max_broadcast).drop("__tk").collect()
    assert {r[0]: tuple(r)[1:] for r in got} == brute_contamination(docs, items)
    assert any(r["contaminated"] for r in got) and not all(r["contaminated"] for r in got)


def test_decontaminate_keeps_columns_repeats_and_empty(spark):
    bench = spark.createDataFrame([(1, words(random.Random(3), 20))], "item_id long, text string")
    bad = bench.first()["text"]
    docs = table(spark, [(1, "clean"), (1, "clean"), (None, bad), (2, bad), (2, "fine too"), (3, None)])
    out = decontaminate.decontaminate(docs, bench)
    assert out.columns == docs.columns
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in out.collect()))) == sorted(
        map(str, [(1, "clean"), (1, "clean"), (2, "fine too"), (3, None)]))
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).count() == 6


# --- 2 ---------------------------------------------------------------------------------------------------------------

def brute_near(docs):
    sets = {}
    for d, t in docs:
        w = BLANKED.findall(lower(t))
        sets[d] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        i = len(sets[a] & sets[b])
        if i and 100 * i >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


@pytest.mark.parametrize("small", [64, 4])  # 4: most lists go the way of long ones
def test_near_dedup(spark, small):
    rng = random.Random(5)
    docs = list(EDGE) + [(8, "one"), (9, "ONE"), (40, "a b c d"), (41, "A b  c\nd")]
    for f in range(4):
        base = words(rng, rng.choice([60, 120, 300]), 2000).split()
        for c in range(30):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 5, 12])):
                w[rng.randrange(len(w))] = f"z{rng.randrange(10 ** 6)}"
            docs.append((100 + 50 * f + c, " ".join(w)))
    got = near_dedup.near_dedup(table(spark, docs), small=small, block=16).collect()
    assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute_near(docs)


def test_near_dedup_chain_nulls_repeats_empty(spark):
    rng = random.Random(6)
    w = words(rng, 100, 5000).split()
    chain = []
    for i in range(12):  # each step changes one word; the ends are far apart
        chain.append((20 - i, " ".join(w)))
        w[8 * i + 3] = f"y{i}"
    docs = chain + [(None, chain[0][1]), (20, chain[0][1]), (50, None), (51, None)]
    got = near_dedup.near_dedup(table(spark, docs)).collect()
    assert len(got) == len(docs)
    assert {r["component_id"] for r in got if r["doc_id"] is not None and r["doc_id"] <= 20} == {9}
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got if r["doc_id"] in (50, 51)} == {(50, 50, True), (51, 51, True)}
    assert [r["kept"] for r in got if r["doc_id"] is None] == [True]
    empty = table(spark, docs).limit(0)
    assert near_dedup.near_dedup(empty).count() == 0


# --- 3 ---------------------------------------------------------------------------------------------------------------

def test_base_spans_match_the_patterns():
    pats = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def ok(k, s):
        d = re.sub("[^0-9]", "", s)
        return [True, k != 1 or all(int(x) <= 255 for x in s.split(".")), 14 <= len(d) <= 19 and pii.luhn(d), 10 <= len(d) <= 15][k]
    rng = random.Random(7)
    alphabet = "aB1290.@+-() %_é\n" + "0123456789" * 2
    for _ in range(3000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))
        want = sorted((m.start(), k, m.end()) for k, p in enumerate(pats) for m in re.finditer(p, t) if ok(k, m.group()))
        assert pii.base_spans(t) == want, t
    assert pii.luhn("4539578763621486") and not pii.luhn("4539578763621487")
    for long in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "+1 " * 50_000):  # linear in the text
        pii.base_spans(long + "@")


def test_pii_skip_edges_and_frame(spark):
    rng = random.Random(8)
    number = lambda: f"+{rng.randrange(1, 9)} {rng.randrange(200, 999)} {rng.randrange(100, 999)} {rng.randrange(1000, 9999)}"
    texts = [(300 + i, f"call {(x := number())} and {x} again or {rng.randrange(99)} of {rng.randrange(2000)} mail a{i}@b.example.com now") for i in range(200)]
    card = "4539578763621486"
    docs = list(EDGE[:6]) + texts + [(900, f"pay {card} please"), (901, f"pay {card} {card} then {card} end")]
    frame = table(spark, docs)
    field = pii.train(frame, sample=150)
    assert field.skip > 0
    out = {r["doc_id"]: r for r in pii.find_pii(frame, field).collect()}
    assert len(out) == len(docs)
    for i, t in docs:
        assert out[i]["base"] == pii.spell(pii.base_spans(t or ""))
        assert set(filter(None, out[i]["base"].split(","))) <= set(out[i]["spans"].split(","))
    plain = {r["doc_id"]: r["spans"] for r in pii.find_pii(frame, pii.Field()).collect()}
    assert plain == {i: r["base"] for i, r in out.items()}
    assert pii.find_pii(frame.limit(0), pii.train(frame.limit(0))).count() == 0


def test_marginals_are_exact_on_a_chain():
    field = pii.Field()
    rng = np.random.default_rng(9)
    field.unary[:] = rng.normal(size=field.unary.shape)
    field.step[:] = rng.normal(size=field.step.shape)
    g = pii.Graph("1 22 333 4444")
    assert g.chain == [0, 1, 2]
    u = field.unary[g.x].sum(axis=1)
    total = np.zeros((4, pii.NONE + 1))
    for y in itertools.product(range(pii.NONE + 1), repeat=4):
        p = math.exp(sum(u[i, y[i]] for i in range(4)) + sum(field.step[y[i], y[i + 1]] for i in range(3)))
        for i in range(4):
            total[i, y[i]] += p
    assert np.allclose(field.marginals(g, rounds=4), total / total.sum(axis=1, keepdims=True))


# --- 4 ---------------------------------------------------------------------------------------------------------------

def test_loser_tree_merges():
    rng = random.Random(10)
    for k in range(9):
        runs = [sorted(rng.randrange(50) for _ in range(rng.randrange(20))) for _ in range(k)]
        assert list(warc.LoserTree(runs)) == sorted(itertools.chain(*runs))


def test_warc_round_trip(spark, tmp_path):
    rng = random.Random(11)
    pages = [(i, f"https://H{rng.randrange(4)}.example.com:80/p/{rng.randrange(5)}?q=1#x", rng.choice(["a\r\n\r\nb", "é", "", None, "WARC/1.0\r\n\r\n", f"u{i}"]))
             for i in range(60)] + [(100, None, "x\x00y"), (None, "http://a.b/c", "only"), (101, "http://a.b/\r\nX: y", "z" * 300_000), (5, "http://dup/", "dup")]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn(
        "ts", F.timestamp_seconds(F.coalesce("page_id", F.lit(7)) % 13 + 1_600_000_000)).withColumn("first", F.lit(1))
    out = warc.archive_and_index(frame, str(tmp_path), archive_bytes=100_000)
    rows = out.collect()
    assert len(rows) == len(pages)
    first = {}
    for i, _, h in sorted(pages, key=lambda p: (p[0] is None, p[0])):
        if i is not None:
            first.setdefault(h or "", i)
    import base64
    want = collections.Counter()
    for i, _, h in pages:
        data = (h or "").encode()
        f = first.get(h or "")
        again = f is not None and f != i
        want[(i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if again else "response", f if again else None)] += 1
    assert collections.Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows) == want
    keys = [(r["url_key"], r["ts"], -1 if r["page_id"] is None else r["page_id"]) for r in rows]
    assert keys == sorted(keys)
    assert "com,example,h1)/p/0?q=1" in {r["url_key"] for r in rows}
    assert warc.archive_and_index(frame.limit(0), str(tmp_path / "none")).count() == 0


def test_broken_archive_is_an_error():
    with pytest.raises(ValueError):
        list(warc.parse_archive("x", b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabc\r\n\r\n"))


# --- 5 and 6 ---------------------------------------------------------------------------------------------------------

def test_exact_dedup(spark):
    docs = list(EDGE) + [(20, "a b"), (21, "ab"), (22, "a  b"), (23, "a b"), (24, "AB"), (25, "a  b"), (None, "ab")] + [(30, "same")] * 3
    got = exact_dedup.exact_dedup(table(spark, docs)).collect()
    groups = collections.defaultdict(list)
    for d, t in docs:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), d is None, d or 0))
    want = collections.Counter()
    for d, t in docs:
        n = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        keep = min(groups[n])
        keep = None if keep[1] else keep[2]
        want[(d, keep, len(groups[n]), d == keep, hashlib.sha256(n.encode()).hexdigest())] += 1
    assert collections.Counter(map(tuple, got)) == want
    assert exact_dedup.exact_dedup(table(spark, docs).limit(0)).count() == 0


@pytest.mark.parametrize("batches,fanout", [(1, 2), (3, 2), (5, 3)])
def test_line_dedup(spark, batches, fanout):
    rng = random.Random(12)
    pool = [f"  A common line number {i} é" for i in range(6)] + ["short", "", "x" * 19, "x" * 20]
    docs = list(EDGE) + [(100 + i, "\n".join(rng.choice(pool + [f"a line of its own {i} {j}"]) for j in range(rng.randrange(1, 9)))) for i in range(40)]
    out = line_dedup.line_dedup(table(spark, docs), batches=batches, fanout=fanout)
    key = lambda line: lower(line.strip(" \t\n\x0b\x0c\r"))
    holders = collections.defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(d)
    want = {}
    for d, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders[key(x)]) < 3 or max(holders[key(x)]) == d]
        want[d] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    assert {r["doc_id"]: (r["__n_lines"], r["__n_dropped"], r["__kept"]) for r in out.collect()} == want
    assert line_dedup.line_dedup(table(spark, docs).limit(0)).count() == 0


def after_first(k1):
    """What Spark's xxhash64(x, 1) makes of xxhash64(x)."""
    h = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), k1 % (1 << 64))
    return h - (1 << 64) if h >> 63 else h


def test_line_keys_have_two_halves(spark):
    line = "a line of more than twenty characters"
    key = line_dedup.line_keys(table(spark, [(1, line)]), "doc_id", "text", 20).first()
    assert key["k2"] != after_first(key["k1"])
    whole = line_dedup._keep(pd.Series([line + "\nx"]), pd.Series([np.array([key["k1"], key["k2"]])]))
    assert whole.values.tolist() == [["x", 1]]
    half = line_dedup._keep(pd.Series([line + "\nx"]), pd.Series([np.array([key["k1"], key["k2"] ^ 1])]))
    assert half.values.tolist() == [[line + "\nx", 0]]


def test_set_keys_have_two_halves(spark):
    run = near_dedup.NearDuplicates(table(spark, [(1, "a b c d e f g")]), "doc_id", "text", 5, 85, 64, 0.594, 64, 512)
    run.classes()
    key = run.members.first()
    assert key["k2"] != after_first(key["k1"])


def test_line_runs_are_levelled(spark, tmp_path):
    runs = line_dedup.LineRuns(spark, str(tmp_path), fanout=2)
    for b in range(5):
        runs.add(spark.createDataFrame([(100 - 10 * b, k, 0) for k in range(b, b + 3)], "id long, k1 long, k2 long"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {(r["k1"], r["n_docs"], r["holder"]) for r in runs.totals().collect()} == {
        (k, min(k + 1, 3, 7 - k), 100 - 10 * max(0, k - 2)) for k in range(7)}


# --- 7 ---------------------------------------------------------------------------------------------------------------

def test_period_meets_every_window():
    rng = random.Random(13)
    for _ in range(40):
        weights = mixing.quantise([rng.random() ** 3 + 1e-6 for _ in range(rng.randrange(1, 15))], 97)
        assert sum(weights) == 97 and min(weights) >= 1
        slots = mixing.period(weights)
        assert sorted(itertools.chain(*slots)) == list(range(97))
        for s, w in enumerate(weights):
            assert len(slots[s]) == w
            done = 0
            for j, t in enumerate(slots[s]):
                assert j * 97 // w <= t < -(-(j + 1) * 97 // w)
            for t in range(97):
                done += t in slots[s]
                assert abs(done - (t + 1) * w / 97) < 1


def test_mix(spark):
    sources = {i: (None if i % 50 == 0 else f"s{min(i % 7, 4) if i % 3 else 0}") for i in range(1500)}
    docs = table(spark, [(i, "t") for i in sources] + [(3, "t")], sources=sources)
    out = mixing.mix(docs, total=50, block=4, bucket_rows=64).toPandas()
    assert len(out) == 1501 and out["mix_pos"].is_unique and set(docs.columns) <= set(out.columns)
    for _, g in out.groupby("source", dropna=False):
        n, w = len(g), g["mix_weight"].iloc[0]
        g = g.sort_values("mix_pos")
        assert list(g["mix_block"]) == [i // 4 for i in range(n)]
        assert ((g["mix_release"] <= g["mix_slot"]) & (g["mix_slot"] < g["mix_deadline"])).all()
        ontarget = out["mix_slot"][out["on_target"]]
        for t in range(0, int(ontarget.max()) + 1, 7):
            assert abs((g["mix_slot"] <= t).sum() / 4 - (t + 1) * w / 50) < 1
    assert list(out.sort_values("mix_pos")["doc_id"]) == list(mixing.mix(docs.repartition(5), total=50, block=4, bucket_rows=8).toPandas().sort_values("mix_pos")["doc_id"])
    assert mixing.mix(docs.limit(0)).count() == 0
    few = mixing.mix(docs, total=3).toPandas()  # two slots a source at least
    assert len(few) == 1501 and few["mix_pos"].is_unique and few.groupby("source", dropna=False)["mix_weight"].first().min() >= 1


# --- 8 ---------------------------------------------------------------------------------------------------------------

def test_forward_sums_all_segmentations():
    lattice = language_id.Lattice(["▁a", "a", "b", "ab", "▁ab", "ba", "c"])
    prob = np.array([[.1], [.2], [.3], [.05], [.15], [.12], [.08]])

    def brute(word, start=0):
        if start == len(word):
            return 1.0
        total, single = 0.0, False
        for end in range(start + 1, len(word) + 1):
            for form in ([word[start:end], "▁" + word[start:end]] if start == 0 else [word[start:end]]):
                if form in lattice.ids:
                    total += prob[lattice.ids[form], 0] * brute(word, end)
                    single |= end == start + 1
        return total + (0.0 if single else 1e-7 * brute(word, start + 1))
    for word in ("a", "ab", "abab", "babac", "xabx", "cc"):
        assert np.isclose(np.exp(language_id.word_scores([word, word], lattice, prob, 1e-7))[1, 0], brute(word))


def test_language_id_held_out_accuracy_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.train(docs.where(~language_id.held_out()), sample=25, rounds=1)
    out = model.predict(docs.where(language_id.held_out()), keep=["doc_id", "lang"]).toPandas()
    assert (out["lang"] == out["lang_pred"]).mean() > 0.95
    edge = model.predict(table(spark, EDGE + [(50, "12 34"), (51, "the")])).toPandas().set_index("doc_id")
    assert list(edge.loc[[0, 1, 2, 3, 50], "lang_pred"]) == ["und"] * 5 and (edge.loc[[0, 1, 2, 3, 50], "score"] == 0).all()
    assert edge.loc[51, "lang_pred"] == "en" and ((edge["score"] >= 0) & (edge["score"] <= 1)).all()
    none = language_id.train(table(spark, EDGE))
    assert {r["lang_pred"] for r in none.predict(table(spark, EDGE)).collect()} == {"und"}


# --- 9 ---------------------------------------------------------------------------------------------------------------

def test_license_scan(spark):
    mit = next(t for label, t in license_scan.TEMPLATES if label == "mit")
    w = mit.split()
    edited = " ".join(w[:10] + ["indeed"] + w[10:30] + w[33:])
    docs = EDGE + [(10, "the MIT license, mit-license; Apache License. general public license"), (11, mit.upper()), (12, "intro " * 50 + edited),
                   (13, " ".join(w[:12])), (14, "license mit apache public license"), (15, "Licensed under CC BY-NC 4.0.")]
    got = {r["doc_id"]: r for r in license_scan.license_scan(table(spark, docs)).collect()}
    assert len(got) == len(docs)
    r = got[10]
    assert (r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["score"]) == (4, 1, 7, "apache,gpl,mit", 1.0)
    assert got[11]["labels"] == "mit" and got[11]["n_base"] == 0 and got[11]["score"] == 1.0
    assert got[12]["labels"] == "mit" and 0.6 < got[12]["score"] < 1 and got[12]["spans"][0]["first"] == 50
    assert got[13]["labels"] == "" and got[14]["n_base"] == 0 and got[15]["labels"] == "cc-by-nc"
    assert (got[0]["n_words"], got[0]["n_base"], got[0]["first_word"], got[0]["base_labels"], got[0]["score"]) == (0, 0, None, "", 0.0)
    assert license_scan.license_scan(table(spark, docs).limit(0)).count() == 0


# --- 10 --------------------------------------------------------------------------------------------------------------

def test_filter_reads_levels_back():
    rng = np.random.default_rng(14)
    h, q = rng.integers(0, 1 << 63, 8000).astype("uint64"), rng.integers(1, 9, 8000)
    filt = np.frombuffer(lm_score.build_block(h, q), "uint8")
    got = lm_score.probe_levels(filt, 1, h)
    assert (got >= q).all() and (got == q).mean() > 0.95
    other = lm_score.probe_levels(filt, 1, rng.integers(1 << 63, (1 << 64) - 1, 20_000, dtype="uint64"))
    assert (other == 0).mean() > 0.9


def test_pair_hash_is_sparks(spark):
    a, b = np.array([1, 5, 2 ** 63 + 9], "uint64"), np.array([0, 7, 2 ** 64 - 1], "uint64")
    frame = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a.view("int64"), b.view("int64"))], "a long, b long")
    want = {(r["a"], r["b"]): r["h"] for r in frame.withColumn("h", F.xxhash64("a", "b")).collect()}
    got = lm_score.pair_hash(a, b).view("int64")
    assert [want[int(x), int(y)] for x, y in zip(a.view("int64"), b.view("int64"))] == got.tolist()


@pytest.mark.parametrize("max_bytes,frequent", [(64 << 20, 50_000), (30_000, 3)])
def test_lm_score(spark, max_bytes, frequent):
    rng = random.Random(15)
    docs = EDGE + [(100 + i, words(rng, rng.randrange(1, 80), 60) + (" Rare%d" % i)) for i in range(60)]
    frame = table(spark, docs)
    held = {r["doc_id"]: r["h"] for r in frame.select("doc_id", lm_score.held_out().alias("h")).collect()}
    out = lm_score.lm_score(frame, frame.where(~lm_score.held_out()), max_bytes=max_bytes, frequent=frequent, bits=16.0)
    toks = {d: BLANKED.findall(lower(t)) + [""] for d, t in docs}
    uni, pairs, hist = collections.Counter(), collections.Counter(), collections.Counter()
    for d, ts in toks.items():
        if not held[d]:
            uni.update(ts)
            pairs.update(zip(["^"] + ts, ts))
            hist.update(["^"] + ts[:-1])
    n, v = sum(uni.values()), len(uni)
    rows = out.collect()
    assert len(rows) == len(docs)
    for r in rows:
        ts = toks[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ts), sum(t in uni for t in ts), n)
        assert math.isclose(r["base_score"], sum(math.log10((uni[t] + 1) / (n + v + 1)) for t in ts), rel_tol=1e-9, abs_tol=1e-9)
        assert r["score"] <= 1e-9
    if frequent > v:
        level = lambda c: lm_score.level_count(np.array([int(math.log2(c)) if c else 0]))[0]
        off = []
        for r in rows:
            ts, s = toks[r["doc_id"]], 0.0
            for a, b in zip(["^"] + ts, ts):
                ca = level(hist[a])
                u = (uni[b] + 1) / (n + v + 1) if b in uni else 1 / (n + v + 1)
                cab = min(level(pairs[a, b]), ca)
                s += math.log10(((cab if cab > 0.5 else 0.0) + 8 * u) / (ca + 8))
            off.append(abs(r["score"] - s) / len(ts))
        assert np.median(off) < 0.02


def test_lm_score_counts_of_one(spark):
    texts = [(i, f"a{i} b{i} c{i}") for i in range(40)] + [(40 + i, "m n") for i in range(5)]
    frame = table(spark, texts)
    train = frame.where("doc_id < 39 or doc_id >= 40")  # document 39 is made of tokens never seen
    toks = {d: t.split() + [""] for d, t in texts}
    uni, pairs, hist = collections.Counter(), collections.Counter(), collections.Counter()
    for d, ts in toks.items():
        if d != 39:
            uni.update(ts), pairs.update(zip(["^"] + ts, ts)), hist.update(["^"] + ts[:-1])
    count = lambda c: float(c) if c < 2 else 1.5 * 2 ** int(math.log2(c))
    n, v = sum(uni.values()), len(uni)
    for r in lm_score.lm_score(frame, train, bits=64.0).collect():
        ts, s = toks[r["doc_id"]], 0.0
        for a, b in zip(["^"] + ts, ts):
            s += math.log10((min(count(pairs[a, b]), count(hist[a])) + 8 * (uni[b] + 1) / (n + v + 1)) / (count(hist[a]) + 8))
        assert math.isclose(r["score"], s, rel_tol=1e-9)


@pytest.mark.parametrize("max_bytes", [64 << 20, 30_000])
def test_lm_score_does_not_depend_on_frequent(spark, max_bytes):
    rng = random.Random(16)
    docs = EDGE + [(100 + i, words(rng, rng.randrange(1, 80), 60) + f" Rare{i} w1 w1 w1") for i in range(40)]
    docs += [(200, docs[-1][1]), (100, docs[8][1])]  # a repeated text, and a repeated row
    frame = table(spark, docs)
    run = lambda **kw: {(r["doc_id"], r["n_tokens"]): tuple(r)[1:] for r in lm_score.lm_score(
        frame, frame.where(~lm_score.held_out()), bits=64.0, **kw).collect()}
    want = run(frequent=50_000)
    for frequent in (0, 5):
        got = run(frequent=frequent, max_bytes=max_bytes)
        assert got.keys() == want.keys()
        for key, row in got.items():
            assert row[:3] == want[key][:3]
            assert np.allclose(row[3:], want[key][3:], rtol=1e-9, atol=1e-9)


def test_lm_score_without_training_texts(spark):
    frame = table(spark, EDGE[:6])
    rows = lm_score.lm_score(frame, frame.limit(0)).collect()
    assert len(rows) == 6 and all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 for r in rows)
    assert lm_score.lm_score(frame.limit(0), frame).count() == 0


# --- stages ----------------------------------------------------------------------------------------------------------

def test_stages_on_whole_table_and_empty(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    near = stages.near_dedup(spark, docs, sf)
    assert near.columns == docs.columns
    assert {r["doc_id"] for r in near.collect()} == {d for d, x in brute_near(texts.items()).items() if x[2]}
    clean = stages.decontaminate(spark, docs, sf)
    assert {r["doc_id"] for r in clean.collect()} == {d for d, x in brute_contamination(texts.items(), items).items() if not x[4]}
    lines = stages.line_dedup(spark, docs, sf)
    assert lines.columns == docs.columns and lines.count() == docs.count()
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    known = stages.language_id(spark, docs, sf)
    assert known.columns == docs.columns
    assert {r["doc_id"] for r in known.collect()} == {d for d, t in texts.items() if re.search(r"[^\W\d_]", t or "")}
    for stage in (stages.near_dedup, stages.line_dedup, stages.language_id, stages.mix_sources, stages.decontaminate):
        assert stage(spark, docs.limit(0), sf).count() == 0
