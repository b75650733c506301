"""Operator 13: quality classifier on random-indexing word vectors.

Word vectors.  Every bucket of words has a sparse random index vector (a few entries of +1 and -1, from a seed).  A word's
vector is the sum of the index vectors of the words that stand within ``WINDOW`` places of it, over all texts: one pass, no learning rate, and
sums of integers, so the result does not depend on partitions or order.  Words (runs of word characters, and runs of marks, case kept) are
hashed into a fixed number of buckets, which bounds the table at every corpus size; the words of a bucket share its
vector, in which the frequent ones prevail.  Spark adds the partitions' tables by bucket, with partial sums before the shuffle.

Documents.  A document is the mean of its words' unit vectors, with the length of that mean and the logarithm of its number of words.

Classifier.  A two-layer numpy network is fitted on the driver on at most ``sample`` labelled documents, those with the smallest hashes of
their ids; a fifth of them is not fitted but used to calibrate: the logit is divided by the temperature with the least log loss there.

Memory: one table of buckets x dim on the driver and in every task (8 MB at the defaults), a chunk of words, and ``sample`` feature rows
on the driver.  The text is read three times (word vectors, labelled documents, scores) and never shuffled.

Defined cases: null and empty texts have no words and get the score of the zero mean; labels that are null, or whose id is null, are not
learned from; with labels of one class or none at all the score is the class's smoothed frequency (0.5 without labels); rows that repeat an id are
scored one by one, and learned from one by one within ``sample``; an empty table gives no rows.  Only the named columns are read, so
other columns may have any name.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"\w+|[^\w\s]+")
WINDOW = 2
CHUNK = 100_000
CACHE = 200_000
ROWS = 1_000


def held_out(id_col: str = "doc_id") -> Column:
    """Documents whose labels are never learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0


def index_vectors(buckets: int, dim: int, ones: int, seed: int) -> np.ndarray:
    """Random +1 / -1 at ``ones`` places of every bucket's vector; the last row, of zeros, stands between documents."""
    rng = np.random.default_rng(seed)
    out = np.zeros((buckets + 1, dim), "int8")
    places = rng.random((buckets, dim)).argsort(axis=1)[:, :ones]
    out[np.arange(buckets)[:, None], places] = rng.choice(np.array([-1, 1], "int8"), (buckets, ones))
    return out


class Buckets:
    """Bucket numbers of a text's words."""

    def __init__(self, buckets: int):
        self.buckets, self.known = buckets, {}

    def __call__(self, text: str | None) -> np.ndarray:
        known, found = self.known, WORD.findall(text or "")
        if len(known) > CACHE:
            known.clear()
        for w in set(found).difference(known):
            known[w] = zlib.crc32(w.encode()) % self.buckets
        return np.fromiter(map(known.__getitem__, found), "int32", len(found))


def chunks(texts, buckets: Buckets):
    """Lists of texts' bucket arrays, about CHUNK words together; a longer text is a chunk of its own."""
    docs, size = [], 0
    for text in texts:
        docs.append(buckets(text))
        size += len(docs[-1])
        if size >= CHUNK:
            yield docs
            docs, size = [], 0
    if docs:
        yield docs


def add_contexts(table: np.ndarray, words: np.ndarray, index: np.ndarray) -> None:
    """Adds the neighbours' index vectors of every word to its row; ``words`` has WINDOW separators around every document."""
    for start in range(0, len(words), CHUNK):  # a long text in pieces, with their neighbours
        part = words[max(0, start - WINDOW):start + CHUNK + WINDOW]
        own = slice(min(start, WINDOW), min(start, WINDOW) + min(CHUNK, len(words) - start))
        e = np.pad(index[part], ((WINDOW, WINDOW), (0, 0)))
        around = sum(e[WINDOW + d:len(e) - WINDOW + d] for d in range(-WINDOW, WINDOW + 1) if d)
        of, around = part[own], around[own]
        order = np.argsort(of, kind="stable")
        of = of[order]
        first = np.flatnonzero(np.diff(of, prepend=-1))
        table[of[first]] += np.add.reduceat(around[order], first, axis=0, dtype="int32")


def word_vectors(docs: DataFrame, text_col: str, buckets: int, dim: int, ones: int, seed: int) -> np.ndarray:
    """Unit context vectors of all buckets, from all texts; buckets without words are zero."""
    names = [f"v{i}" for i in range(dim)]

    def run(batches):
        index, cut = index_vectors(buckets, dim, ones, seed), Buckets(buckets)
        table, gap = np.zeros((buckets + 1, dim), "int64"), np.full(WINDOW, buckets, "int32")
        for pdf in batches:
            for docs in chunks(pdf["text"], cut):
                add_contexts(table, np.concatenate([x for d in docs for x in (d, gap)]), index)
        used = np.flatnonzero(table[:buckets].any(axis=1))
        for at in range(0, len(used), ROWS):
            rows = used[at:at + ROWS]
            yield pd.DataFrame(table[rows], columns=names).assign(bucket=rows.astype("int32"))

    sums = (docs.select(F.col(text_col).alias("text")).mapInPandas(run, ", ".join(f"{n} long" for n in names) + ", bucket int")
            .groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]))
    out = np.zeros((buckets + 1, dim))
    for r in sums.collect():  # at most `buckets` rows
        out[r["bucket"]] = r[1:]
    length = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, length, out=np.zeros_like(out), where=length > 0).astype("float32")


def pooled(docs: list[np.ndarray], vectors: np.ndarray) -> np.ndarray:
    """Feature rows of documents given as bucket arrays."""
    out = np.zeros((len(docs), vectors.shape[1] + 2), "float32")
    for i, d in enumerate(docs):
        if len(d):
            seen, times = np.unique(d, return_counts=True)
            mean = times.astype("float32") @ vectors[seen] / len(d)
            out[i, :-2] = mean
            out[i, -2] = np.linalg.norm(mean)
            out[i, -1] = math.log1p(len(d))
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Network:
    """Standardised features, one hidden layer of tanh units, one logit, and the temperature that divides it."""

    def __init__(self, mean, scale, w1, b1, w2, b2, temperature=1.0):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2, self.temperature = mean, scale, w1, b1, w2, b2, temperature

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probabilities to 9 decimals: a row's last bits depend on the batch in which its matrix product is made."""
        return np.round(_sigmoid(self.logits(x) / self.temperature).astype("float64"), 9)


def log_loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit_network(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, rate: float = 0.01, decay: float = 1e-4, seed: int = 5) -> Network:
    """Adam on the log loss, batches of 256 in a seeded order."""
    rng = np.random.default_rng(seed)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z, d = (x - mean) / scale, x.shape[1]
    params = [rng.normal(0, 1 / math.sqrt(d), (d, hidden)), np.zeros(hidden), rng.normal(0, 1 / math.sqrt(hidden), hidden), np.zeros(1)]
    m, v, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        order = rng.permutation(len(z))
        for at in range(0, len(z), 256):
            rows = order[at:at + 256]
            a = np.tanh(z[rows] @ params[0] + params[1])
            err = (_sigmoid(a @ params[2] + params[3]) - y[rows]) / len(rows)
            back = np.outer(err, params[2]) * (1 - a * a)
            grads = [z[rows].T @ back + decay * params[0], back.sum(axis=0), a.T @ err + decay * params[2], err.sum(keepdims=True)]
            t += 1
            for i, g in enumerate(grads):
                m[i] += 0.1 * (g - m[i])
                v[i] += 0.001 * (g * g - v[i])
                params[i] -= rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)
    return Network(mean, scale, params[0], params[1], params[2], params[3][0])


def fit_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """Temperature between 0.05 and 20 of least log loss: golden-section search of its logarithm, along which the loss has one minimum."""
    low, high, g = math.log(0.05), math.log(20), (math.sqrt(5) - 1) / 2
    loss = lambda u: log_loss(logits / math.exp(u), y)
    for _ in range(60):
        a, b = high - g * (high - low), low + g * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


class Constant:
    """Where there is nothing to tell classes apart."""

    def __init__(self, score: float):
        self.score = score

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.score)


def fit(x: np.ndarray, y: np.ndarray, apart: np.ndarray):
    """Network fitted on the rows outside ``apart`` and calibrated on those inside."""
    if len(set(y[~apart])) < 2:
        return Constant((y.sum() + 1) / (len(y) + 2))
    net = fit_network(x[~apart], y[~apart])
    if len(set(y[apart])) == 2:
        net.temperature = fit_temperature(net.logits(x[apart]), y[apart])
    return net


class QualityModel:
    """Word vectors of ``docs`` and a classifier of their labels."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality",
                 sample: int = 20_000, buckets: int = 1 << 14, dim: int = 64, ones: int = 8, seed: int = 11):
        sc = docs.sparkSession.sparkContext
        self.id_col, self.text_col, self.buckets = id_col, text_col, buckets
        self.vectors = sc.broadcast(word_vectors(docs, text_col, buckets, dim, ones, seed))
        place = F.xxhash64(F.lit(seed), F.col(id_col).cast("string"))
        known = (labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("y"))
                 .orderBy(F.xxhash64(F.lit(seed), F.col("id").cast("string")), "id", "y").limit(sample))
        rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), place.alias("place"))
                .join(F.broadcast(known), "id").select("place", "y", "text"))  # at most `sample` small rows
        vectors, size = self.vectors, buckets

        def run(batches):
            cut = Buckets(size)
            for pdf in batches:
                x = pooled([cut(t) for t in pdf["text"]], vectors.value)
                yield pd.DataFrame({"place": pdf["place"], "y": pdf["y"], "x": [r.tobytes() for r in x]})

        got = rows.mapInPandas(run, "place long, y int, x binary").orderBy("place", "y", "x").limit(sample).collect()
        x = np.array([np.frombuffer(r["x"], "float32") for r in got], "float32").reshape(len(got), dim + 2)
        y = np.array([r["y"] for r in got], "float64")
        apart = np.array([r["place"] % 5 == 0 for r in got], bool)
        self.net = fit(x, y, apart)

    def score(self, docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
        """The columns ``keep`` (default: the id) and ``score``, the calibrated probability of label 1."""
        keep = keep or [self.id_col]
        names = [f"k{i}" for i in range(len(keep))]  # whatever the columns are called
        vectors, size, net = self.vectors, self.buckets, self.net

        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            cut = Buckets(size)
            for texts in batches:
                yield pd.Series(net.scores(pooled([cut(t) for t in texts], vectors.value)))

        udf = F.pandas_udf(run, "double")
        out = docs.select(*[F.col(k).alias(n) for k, n in zip(keep, names)], udf(F.col(self.text_col)).alias("p"))
        return out.select(*[F.col(n).alias(k) for n, k in zip(names, keep)], F.col("p").alias("score"))


def predicted(threshold: float = 0.3) -> Column:
    """1 where the score reaches the threshold, else 0."""
    return (F.col("score") >= threshold).cast("int")
