"""Item / word embeddings.

Training follows the distributed parameter-averaging scheme: per iteration
the three weight matrices are broadcast, every partition of (checkpointed)
sentences runs local SGD with a vectorised numpy kernel (``mapInPandas``),
emits only the rows it modified, and rows are averaged per (matrix, row) by
a Spark aggregate.  The averaged rows are the only data that returns to the
driver; the model size is checked (``vocab * dim < 2^31``) before training.

Kernel semantics: skip-gram uses the context word's input vector to predict
the centre word; CBOW sums the context vectors; hierarchical softmax walks
the Huffman code of the centre word; negative sampling draws from
``cn^0.75``.  Sigmoid arguments are clipped at +-6 (hierarchical-softmax
steps outside are skipped, negative sampling saturates).  The learning rate
decays linearly over all iterations to a floor of ``step * 1e-4``.  Updates
are applied in mini-batches of pairs (``np.add.at``).

The default configuration (skip-gram, hierarchical softmax, no negative
sampling, no subsampling) is delegated to ``pyspark.ml.feature.Word2Vec``.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark import StorageLevel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import distance as D
from tessera.operators import corpus as C
from tessera.operators import knn as K
from tessera.operators import lsh as H
from tessera.operators.topn import tie_key
from tessera.session import ensure_checkpoint_dir, ship_package

# Fixed value: sigmoid arguments are clipped at +-6.
MAX_EXP = 6.0


def huffman_codes(counts: np.ndarray):
    """Huffman code and inner-node path per word (vocabulary-sized helper).

    Returns (codes, points) lists; inner nodes are numbered 0..V-2.
    """
    v = len(counts)
    if v == 1:
        return [np.zeros(1, np.int8)], [np.zeros(1, np.int64)]
    heap = [(int(c), i) for i, c in enumerate(counts)]
    heapq.heapify(heap)
    parent = np.zeros(2 * v - 1, np.int64)
    bit = np.zeros(2 * v - 1, np.int8)
    nxt = v
    while len(heap) > 1:
        c1, a = heapq.heappop(heap)
        c2, b = heapq.heappop(heap)
        parent[a], parent[b], bit[b] = nxt, nxt, 1
        heapq.heappush(heap, (c1 + c2, nxt))
        nxt += 1
    root = nxt - 1
    codes, points = [], []
    for w in range(v):
        code, path, n = [], [], w
        while n != root:
            code.append(bit[n])
            n = parent[n]
            path.append(n - v)
        codes.append(np.array(code[::-1], np.int8))
        points.append(np.array(path[::-1], np.int64))
    return codes, points


def _sig(x):
    return 1.0 / (1.0 + np.exp(-x))


def _add_rows(m: np.ndarray, rows: np.ndarray, v: np.ndarray) -> None:
    """``np.add.at(m, rows, v)`` of a contiguous matrix by flat positions: the same sums in the same order, on numpy's fast path."""
    np.add.at(m.reshape(-1), (rows[:, None] * m.shape[1] + np.arange(m.shape[1])).ravel(), v.ravel())


def _train_partition(params: dict, bc_model, bc_tables, iteration: int):
    dim, window, neg = params["dim"], params["window"], params["negative"]
    hs, cbow, sample = params["hs"], params["cbow"], params["sample"]
    step, total, iters, nparts = params["step"], params["total"], params["iters"], params["parts"]
    seed, batch = params["seed"], params["batch"]

    def fn(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        syn0, syn1, syn1neg = (m.copy() for m in bc_model.value)  # never mutate the broadcast
        cn, cum, codes, points = bc_tables.value
        maxc = max((len(c) for c in codes), default=1)
        code_m = np.full((len(codes), maxc), -1, np.int64)
        point_m = np.zeros((len(codes), maxc), np.int64)
        for i, (c, p) in enumerate(zip(codes, points)):
            code_m[i, :len(c)], point_m[i, :len(p)] = c, p
        touched0 = np.zeros(len(syn0), bool)
        touched1 = np.zeros(len(syn1), bool)
        touchedn = np.zeros(len(syn1neg), bool)
        words_seen, loss, npairs = 0, 0.0, 0
        for pdf in batches:
            for sid, words in zip(pdf["sid"], pdf["words"]):
                w = np.asarray(words, np.int64)
                rng = np.random.default_rng([seed, iteration, int(sid) & 0x7FFFFFFFFFFFFFFF, len(w)])
                words_seen += len(w)  # the rate falls with the words of the full sentence
                if sample > 0 and len(w):
                    x = cn[w] / (sample * total)
                    w = w[((np.sqrt(x) + 1) / x) >= rng.random(len(w))]
                if len(w) < 2:
                    continue
                progress = (iteration * total + nparts * words_seen) / (iters * total + 1)
                alpha = max(step * (1 - progress), step * 1e-4)
                L = len(w)
                radius = window - rng.integers(0, window, L)
                pos = np.arange(L)
                if cbow:
                    ctx_lists = []
                    for o in range(-window, window + 1):
                        if o == 0:
                            continue
                        q = pos + o
                        ok = (np.abs(o) <= radius) & (q >= 0) & (q < L)
                        ctx_lists.append(np.where(ok, w[np.clip(q, 0, L - 1)], -1))
                    ctx = np.stack(ctx_lists, 1)  # L x 2*window, -1 = none
                    has = (ctx >= 0).any(1)
                    for b0 in range(0, L, batch):
                        sl = slice(b0, b0 + batch)
                        cm, centre = ctx[sl][has[sl]], w[sl][has[sl]]
                        if not len(centre):
                            continue
                        valid = cm >= 0
                        h = (syn0[np.where(valid, cm, 0)] * valid[..., None]).sum(1)
                        grad, l_, touched = _output_step(h, centre, syn1, syn1neg, code_m, point_m,
                                                         hs, neg, cum, rng, alpha)
                        loss += l_
                        npairs += len(centre)
                        touched1[touched[0]] = True
                        touchedn[touched[1]] = True
                        rows = np.where(valid, cm, 0)[valid]
                        _add_rows(syn0, rows, np.repeat(grad, valid.sum(1), axis=0))
                        touched0[rows] = True
                else:
                    cs, xs = [], []
                    for o in range(-window, window + 1):
                        if o == 0:
                            continue
                        q = pos + o
                        ok = (np.abs(o) <= radius) & (q >= 0) & (q < L)
                        cs.append(w[pos[ok]])
                        xs.append(w[q[ok]])
                    centre, context = np.concatenate(cs), np.concatenate(xs)
                    for b0 in range(0, len(centre), batch):
                        ce, cx = centre[b0:b0 + batch], context[b0:b0 + batch]
                        h = syn0[cx]
                        grad, l_, touched = _output_step(h, ce, syn1, syn1neg, code_m, point_m,
                                                         hs, neg, cum, rng, alpha)
                        loss += l_
                        npairs += len(ce)
                        touched1[touched[0]] = True
                        touchedn[touched[1]] = True
                        _add_rows(syn0, cx, grad)
                        touched0[cx] = True
        out = []
        for mid, mat, t in ((0, syn0, touched0), (1, syn1, touched1), (2, syn1neg, touchedn)):
            idx = np.nonzero(t)[0]
            if len(idx):
                out.append(pd.DataFrame({"matrix": mid, "idx": idx.astype(np.int64),
                                         "vec": list(mat[idx].astype(np.float64))}))
        out.append(pd.DataFrame({"matrix": [-1], "idx": [0], "vec": [np.array([loss, npairs], float)]}))
        yield pd.concat(out, ignore_index=True)
    return fn


def _output_step(h, centre, syn1, syn1neg, code_m, point_m, hs, neg, cum, rng, alpha):
    """One mini-batch through the output layer; returns input gradient, loss."""
    grad = np.zeros_like(h)
    loss = 0.0
    t1 = np.zeros(0, np.int64)
    tn = np.zeros(0, np.int64)
    if hs:
        code, point = code_m[centre], point_m[centre]
        valid = code >= 0
        f = np.einsum("bd,bld->bl", h, syn1[point])
        upd = valid & (f > -MAX_EXP) & (f < MAX_EXP)
        g = np.where(upd, (1 - code - _sig(f)) * alpha, 0.0)
        grad += np.einsum("bl,bld->bd", g, syn1[point])
        _add_rows(syn1, point[upd], (g[..., None] * h[:, None, :])[upd])
        t1 = point[upd]
        p = np.clip(_sig(f), 1e-12, 1 - 1e-12)
        loss += -np.where(valid, np.where(code == 0, np.log(p), np.log(1 - p)), 0.0).sum()
    if neg > 0:
        draws = np.searchsorted(cum, rng.random((len(centre), neg)), side="right")
        draws = np.minimum(draws, len(cum) - 1)
        tgt = np.concatenate([centre[:, None], draws], 1)
        label = np.zeros(tgt.shape)
        label[:, 0] = 1.0
        keep = np.ones(tgt.shape, bool)
        keep[:, 1:] = draws != centre[:, None]  # a draw equal to the centre is skipped
        f = np.einsum("bd,bkd->bk", h, syn1neg[tgt])
        s = np.where(f > MAX_EXP, 1.0, np.where(f < -MAX_EXP, 0.0, _sig(f)))
        g = np.where(keep, (label - s) * alpha, 0.0)
        grad += np.einsum("bk,bkd->bd", g, syn1neg[tgt])
        _add_rows(syn1neg, tgt[keep], (g[..., None] * h[:, None, :])[keep])
        tn = tgt[keep]
        p = np.clip(_sig(f), 1e-12, 1 - 1e-12)
        loss += -np.where(keep, np.where(label == 1, np.log(p), np.log(1 - p)), 0.0).sum()
    return grad, loss, (t1, tn)


def average_parameters(rows: DataFrame) -> DataFrame:
    """Mean vector per (matrix, idx) over the partitions that emitted it."""
    return (rows.groupBy("matrix", "idx")
            .agg(vector_to_array(Summarizer.mean(array_to_vector("vec"))).alias("vec")))


class EmbeddingModel:
    def __init__(self, vectors: DataFrame, losses: list[float]):
        self.vectors = vectors
        self.losses = losses

    def embedding_table(self) -> DataFrame:
        """(word, vector array<double>)."""
        return self.vectors


def fit_embeddings(df: DataFrame, tokens: str = "tokens", sid: str | None = None,
                   vector_size: int = 100, window: int = 5, min_count: int = 5,
                   max_iter: int = 1, negative: int = 0, hs: int = 1, cbow: int = 0,
                   sample: float = 0.0, step_size: float = 0.025, num_partitions: int = 1,
                   max_len: int = 1000, seed: int = 42, batch: int = 256,
                   order: list[str] | None = None) -> EmbeddingModel:
    """Train embeddings; returns a model whose table is (word, vector).

    ``df`` holds sentences as arrays in ``tokens``, or -- with ``order`` given --
    the long form: one row per token (``sid``, ``order`` columns, ``tokens``
    as the word column), so no sentence has to exist as one row.
    """
    if vector_size < 1 or window < 1 or min_count < 0 or max_iter < 1 or num_partitions < 1:
        raise ValueError("vector_size, window, max_iter, num_partitions must be >= 1")
    if negative < 0 or hs not in (0, 1) or cbow not in (0, 1):
        raise ValueError("negative >= 0, hs and cbow in {0, 1}")
    if negative == 0 and hs == 0:
        raise ValueError("negative and hs cannot both be 0")
    if not 0 <= sample <= 1 or step_size <= 0:
        raise ValueError("sample in [0, 1], step_size > 0")
    spark = df.sparkSession
    ship_package(spark)
    if cbow == 0 and hs == 1 and negative == 0 and sample == 0 and order is None:
        from pyspark.ml.feature import Word2Vec
        w2v = Word2Vec(vectorSize=vector_size, windowSize=window, minCount=min_count, maxIter=max_iter,
                       numPartitions=num_partitions, stepSize=step_size, maxSentenceLength=max_len,
                       seed=seed, inputCol=tokens, outputCol="__out")
        m = w2v.fit(df.select(F.col(tokens).cast("array<string>").alias(tokens)))
        vec = m.getVectors().select(F.col("word"), vector_to_array("vector").alias("vector"))
        return EmbeddingModel(vec, [])
    if order is not None:
        # long form: one row per token, ordered by ``order`` inside ``sid``
        if sid is None:
            raise ValueError("the long form needs a sentence id column")
        long = df.select(F.col(sid).alias("sid"), *[F.col(o) for o in order],
                         F.col(tokens).cast("string").alias("word"))
        vocab = C.vocab_from_words(long, "word", min_count)
    else:
        x = df if sid else df.withColumn("__sid", F.monotonically_increasing_id())
        sid = sid or "__sid"
        x = x.select(F.col(sid).alias("sid"), F.col(tokens).cast("array<string>").alias("tokens"))
        vocab = C.build_vocab(x, "tokens", min_count)
    vp = vocab.orderBy("idx").toPandas()  # vocabulary-sized, needed by every task anyway
    V = len(vp)
    if V == 0:
        raise ValueError("the vocabulary is empty; lower min_count")
    if V * vector_size >= 2 ** 31:
        raise ValueError("vocabulary size * vector size must be < 2^31")
    cn = vp["cn"].to_numpy(np.float64)
    total = float(cn.sum())
    w = cn ** 0.75
    cum = np.cumsum(w) / w.sum()
    codes, points = huffman_codes(cn) if hs else ([], [])
    enc = (C.encode_long(long, vocab, "sid", list(order), "word", max_len) if order is not None
           else C.encode_sentences(x, vocab, "tokens", "sid", max_len))
    sent = (enc.groupBy("sid", "chunk")
            .agg(F.sort_array(F.collect_list(F.struct("pos", "idx"))).alias("s"))
            # one long key per (sentence, chunk) for the kernel's seeded draws
            .select(F.xxhash64("sid", "chunk").alias("sid"), F.col("s.idx").alias("words")))
    ensure_checkpoint_dir(spark)
    # fixed order inside partitions (SGD is order dependent); reliable checkpoint cuts lineage
    sent = sent.repartition(num_partitions, "sid").sortWithinPartitions("sid")
    # persist first so the checkpoint write does not recompute the encoding
    sent.persist(StorageLevel.MEMORY_AND_DISK)
    staged = sent
    sent = sent.checkpoint()
    staged.unpersist()
    rng = np.random.default_rng(seed)
    syn0 = ((rng.random((V, vector_size)) - 0.5) / vector_size).astype(np.float64)
    # only the output matrices of the chosen modes take room
    syn1 = np.zeros((max(V - 1, 1) if hs else 0, vector_size))
    syn1neg = np.zeros((V if negative else 0, vector_size))
    sc = spark.sparkContext
    tables = sc.broadcast((cn, cum, codes, points))
    params = dict(dim=vector_size, window=window, negative=negative, hs=hs, cbow=cbow, sample=sample,
                  step=step_size, total=total, iters=max_iter, parts=num_partitions, seed=seed, batch=batch)
    schema = "matrix int, idx long, vec array<double>"
    losses = []
    for it in range(max_iter):
        model = sc.broadcast((syn0, syn1, syn1neg))
        rows = sent.mapInPandas(_train_partition(params, model, tables, it), schema)
        # one action per iteration: the partitions' (loss, pairs) rows are
        # averaged with the parameters, and the ratio of means is that of sums
        avg = average_parameters(rows).toPandas()  # model-sized
        loss, pairs = np.mean(np.stack(avg[avg["matrix"] == -1]["vec"].to_numpy()), axis=0)
        losses.append(float(loss / pairs) if pairs else float("nan"))
        for mid, mat in ((0, syn0), (1, syn1), (2, syn1neg)):
            part = avg[avg["matrix"] == mid]
            if len(part):
                mat[part["idx"].to_numpy()] = np.stack(part["vec"].to_numpy())
        model.unpersist(blocking=True)
    tables.unpersist(blocking=True)
    # plain Python values: works with or without Arrow conversion enabled
    vec = spark.createDataFrame(list(zip(vp["word"].astype(str).tolist(), syn0.tolist())),
                                "word string, vector array<double>")
    return EmbeddingModel(vec, losses)


def embed_sentences(df: DataFrame, tokens: str, emb: DataFrame, id_col: str, dim: int,
                    word: str = "word", vector: str = "vector", out: str = "embedding") -> DataFrame:
    """Sum of known word vectors / sentence length (unknown words count in
    the divisor); empty sentences give the zero vector."""
    e = df.select(F.col(id_col), F.explode(F.col(tokens)).alias("__w"))
    ev = emb.select(F.col(word).alias("__w"), array_to_vector(F.col(vector).cast("array<double>")).alias("__v"))
    s = e.join(ev, "__w").groupBy(id_col).agg(vector_to_array(Summarizer.sum(F.col("__v"))).alias("__s"))
    zeros = F.array_repeat(F.lit(0.0), dim)
    n = F.size(F.col(tokens))
    return (df.join(s, id_col, "left")
            .withColumn(out, F.when(n > 0, F.transform(F.coalesce("__s", zeros), lambda v: v / n))
                        .otherwise(zeros)).drop("__s"))


def embed_sentences_long(tokens: DataFrame, id_col: str, word: str, emb: DataFrame, dim: int,
                         emb_word: str = "word", vector: str = "vector",
                         out: str = "embedding") -> DataFrame:
    """D9 on the long form (one row per token): summed known vectors divided by
    the sentence's token count.  Map-side partial aggregation combines a long
    sentence before the shuffle; sentences are never materialised as rows."""
    ev = emb.select(F.col(emb_word).cast("string").alias("__w"),
                    array_to_vector(F.col(vector).cast("array<double>")).alias("__v"))
    t = tokens.select(F.col(id_col), F.col(word).cast("string").alias("__w"))
    n = t.groupBy(id_col).agg(F.count(F.lit(1)).alias("__n"))
    s = t.join(ev, "__w").groupBy(id_col).agg(vector_to_array(Summarizer.sum(F.col("__v"))).alias("__s"))
    # sentences without any known word: zero vector of the model's size
    zeros = F.array_repeat(F.lit(0.0), dim)
    return (n.join(s, id_col, "left")
            .select(id_col, F.when(F.col("__s").isNull(), zeros)
                    .otherwise(F.transform("__s", lambda v: v / F.col("__n"))).alias(out)))


def find_synonyms_vec(emb: DataFrame, vec, num: int, word: str = "word", vector: str = "vector",
                      exclude: str | None = None) -> DataFrame:
    """(word, similarity) -- signed cosine, top ``num``; zero norm -> 0."""
    q = F.array(*[F.lit(float(x)) for x in vec])
    v = F.col(vector).cast("array<double>")
    den = D.norm(v) * D.norm(q)
    sim = F.when(den > 0, D.dot(v, q) / den).otherwise(0.0)
    x = emb.select(F.col(word).alias("word"), sim.alias("similarity"))
    if exclude is not None:
        x = x.filter(F.col("word") != F.lit(exclude))
    return x.orderBy(tie_key("similarity").desc(), F.col("word").asc()).limit(num)


def find_synonyms(emb: DataFrame, w, num: int, word: str = "word", vector: str = "vector") -> DataFrame:
    """Synonyms of a word (the word itself excluded)."""
    row = emb.filter(F.col(word) == F.lit(w)).select(vector).first()  # one vector
    if row is None:
        raise ValueError(f"word {w!r} not in vocabulary")
    return find_synonyms_vec(emb, row[0], num, word, vector, exclude=w)


def _as_similarity(nn: DataFrame) -> DataFrame:
    return nn.select(F.col("src").alias("item1"), F.col("cand").alias("item2"),
                     (F.lit(1.0) - F.col("distance")).alias("sim"))


def i2i_exact(emb: DataFrame, top: int = 100, word: str = "word", vector: str = "vector",
              block_size: int = 1024) -> DataFrame:
    """Exact top-N items by |cosine| for every item -> (item1, item2, sim)."""
    return _as_similarity(K.knn_self(emb, top, "cosine", word, vector, block_size))


def i2i_lsh(emb: DataFrame, top: int = 100, num_hashes: int = 200, signature_length: int | None = None,
            bucket_limit: int = 1000, seed: int = 42, word: str = "word",
            vector: str = "vector") -> DataFrame:
    """LSH top-N by |cosine|; signature length ``floor(ln n)`` by default."""
    first = emb.select(vector).first()
    if first is None:
        kind = emb.schema[word].dataType.simpleString()
        return emb.sparkSession.createDataFrame([], f"item1 {kind}, item2 {kind}, sim double")
    if signature_length is None:
        signature_length = H.signature_length_for(emb.count())
    fam = H.HashFamily("signRP", len(first[0]), num_hashes, min(signature_length, num_hashes), seed=seed)
    return _as_similarity(H.lsh_self(emb, top, fam, word, vector, bucket_limit))
