"""Corpus preparation for item / word embeddings.

Sentences are long tables ``(sid, pos, word)`` inside; arrays only at the
edges.  Positions are renumbered with ``ordered_scan`` so a very long
sentence is not one task's job; every random choice is a seeded stable
uniform of (sentence, position), identical under retries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.indexing import global_index
from tessera.functions.scan import HOT_ROWS, hot_groups, hot_sums, ordered_scan, written
from tessera.functions.stable import stable_u01


FREQUENT = 50_000  # words that are looked up where the tokens are


def vocab_from_words(words: DataFrame, word: str = "word", min_count: int = 5) -> DataFrame:
    """D1 on the long form (one row per token): (word, cn, idx)."""
    w = words.select(F.col(word).cast("string").alias("word")).where(F.col("word").isNotNull())
    counts = w.groupBy("word").agg(F.count(F.lit(1)).alias("cn")).filter(F.col("cn") >= min_count)
    return global_index(counts, [F.col("cn").desc(), F.col("word").asc()], "idx")


def build_vocab(df: DataFrame, tokens: str = "tokens", min_count: int = 5) -> DataFrame:
    """(word, cn, idx) for words with ``cn >= min_count``; idx by count
    descending, then word.  An empty vocabulary is an error at fit time."""
    return vocab_from_words(df.select(F.explode(F.col(tokens)).alias("word")), "word", min_count)


def encode_long(tokens: DataFrame, vocab: DataFrame, sid: str = "sid", order=("opos",),
                word: str = "word", max_len: int = 1000, hot: DataFrame | None | str = "find") -> DataFrame:
    """D2 on the long form ``(sid, order..., word)`` -- one row per token, so a
    sentence of any length is never one row: known words only, renumbered
    1.. per sentence by a skew-safe scan, cut into chunks of ``max_len``.

    ``hot``: the sentences that the scan must split, found from the tokens (known or not) when not given, so that the
    encoded rows go from the join to the scan and are written only when there is such a sentence."""
    if max_len < 1:
        raise ValueError("max_len must be >= 1")
    if isinstance(hot, str):
        hot = hot_groups(tokens, [sid])
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    e = tokens.select(F.col(sid).alias("sid"), *order, F.col(word).cast("string").alias("word"))
    # a bounded part of the vocabulary goes to the tokens, and only tokens that it does not hold go to the rest of it
    words, first = vocab.select("word", "idx"), F.coalesce(F.col("idx").between(0, FREQUENT - 1), F.lit(False))
    near, rest = F.broadcast(words.where(first)), words.where(~first)
    k = e.join(near, "word")
    if not rest.isEmpty():  # its part of a partition is hashed: tokens need no sort by word
        k = k.unionByName(e.join(near, "word", "left_anti").join(rest.hint("shuffle_hash"), "word"))
    # both halves of a split scan read their input
    r = ordered_scan(k if hot is None else written(k), ["sid"], [o.asc() for o in order], pos="pos", hot=hot)
    return r.select("sid", F.floor((F.col("pos") - 1) / max_len).cast("long").alias("chunk"),
                    "pos", "word", "idx")


def encode_sentences(df: DataFrame, vocab: DataFrame, tokens: str = "tokens", sid: str = "sid",
                     max_len: int = 1000) -> DataFrame:
    """(sid, chunk, pos, word, idx): known words only, renumbered 1.. per
    sentence, cut into chunks of ``max_len`` (``chunk = (pos - 1) // max_len``)."""
    hot = hot_sums(df.select(F.col(sid).alias("sid"), F.size(tokens).alias("n")), ["sid"], "n", HOT_ROWS)
    e = df.select(F.col(sid).alias("sid"), F.posexplode(F.col(tokens)).alias("opos", "word"))
    return encode_long(e, vocab, "sid", ["opos"], "word", max_len, hot)


def subsample(encoded: DataFrame, vocab: DataFrame, sample: float = 1e-3, seed: int = 42,
              formula: str = "published", max_len: int | None = None) -> DataFrame:
    """D3: drop frequent words at random (keep if ``p >= stable_u01(sid, pos)``),
    then renumber positions and chunks are kept.  ``sample = 0`` is a no-op.

    ``max_len``: the most rows of a chunk, if known.  Chunks that the scan need not split are numbered where they are, and nothing is written."""
    if not 0 <= sample <= 1:
        raise ValueError("sample must be in [0, 1]")
    if sample == 0:
        return encoded
    total = vocab.agg(F.sum("cn").alias("total"))
    x = encoded.join(vocab.select("idx", "cn"), "idx").crossJoin(F.broadcast(total))  # one-row total
    xx = F.col("cn") / (F.lit(sample) * F.col("total"))
    p = (F.sqrt(xx) + 1) / xx if formula == "published" else F.sqrt(xx + 1) / xx
    # a draw is below 1: words that are always kept need none
    kept = (x.filter(F.when(p >= 1, True).otherwise(p >= stable_u01("sid", seed, F.col("pos"))))
            .select("sid", "chunk", F.col("pos").alias("old_pos"), "word", "idx"))
    small = max_len is not None and max_len <= HOT_ROWS
    # written: the scan reads it twice, and the draws are costly
    r = ordered_scan(kept if small else written(kept), ["sid", "chunk"], [F.col("old_pos").asc()], pos="pos", hot=None if small else "find")
    return r.select("sid", "chunk", "pos", "word", "idx")


def context_pairs(encoded: DataFrame, window: int = 5, seed: int = 42) -> DataFrame:
    """Skip-gram (centre, context) pairs with a dynamic window.

    Each centre position gets ``radius = window - b``, ``b = floor(u * window)``
    with ``u = stable_u01(sid, pos)``; its contexts are the positions within
    ``radius`` in the same chunk.  Offsets are exploded per centre and
    equi-joined on (sid, chunk, position): no band join, no sentence-sized
    task.
    """
    if window < 1:
        raise ValueError("window must be >= 1")
    b = F.floor(stable_u01("sid", seed, F.col("pos"), F.lit("w")) * window).cast("int")
    c = encoded.select("sid", "chunk", "pos", F.col("idx").alias("centre"), (F.lit(window) - b).alias("radius"))
    offs = F.filter(F.sequence(-F.col("radius"), F.col("radius")), lambda o: o != 0)
    c = c.select("sid", "chunk", "pos", "centre", F.explode(offs).alias("off"))
    c = c.withColumn("cpos", F.col("pos") + F.col("off"))
    ctx = encoded.select("sid", "chunk", F.col("pos").alias("cpos"), F.col("idx").alias("context"))
    return c.join(ctx, ["sid", "chunk", "cpos"]).select("sid", "chunk", "pos", "centre", "context")


def noise_distribution(vocab: DataFrame, power: float = 0.75) -> DataFrame:
    """(idx, prob, cum) with ``prob = cn^power / sum`` and ``cum`` the
    inclusive cumulative probability in idx order (vocabulary-sized)."""
    w = vocab.select("idx", F.pow(F.col("cn").cast("double"), power).alias("w"))
    s = ordered_scan(w.withColumn("__all", F.lit(0)), ["__all"], [F.col("idx").asc()], ["w"],
                     pos="__p", method="range")
    tot = w.agg(F.sum("w").alias("__tot"))
    return s.crossJoin(F.broadcast(tot)).select(  # one-row total
        "idx", (F.col("w") / F.col("__tot")).alias("prob"), (F.col("cum_w") / F.col("__tot")).alias("cum"))


def negative_samples(pairs: DataFrame, noise: DataFrame, k: int = 5, seed: int = 42,
                     buckets: int | None = None) -> DataFrame:
    """``k`` noise words per pair by inverse-CDF lookup of a stable uniform;
    a draw equal to the centre is skipped, not redrawn.

    The lookup is a distributed range join: each noise word's interval
    ``[cum - prob, cum)`` is exploded into the ``buckets`` equal-width cells
    of [0, 1) it overlaps (about ``vocabulary + buckets`` rows; by default as
    many cells as words, so a cell meets about two intervals), every draw
    goes to the cell of its uniform, and an equi-join on the cell plus the
    interval test picks the word.  Nothing is collected to the driver.
    """
    buckets = buckets or max(1, noise.count())
    x = pairs.select("*", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("draw"))
    x = x.withColumn("__u", stable_u01("sid", seed, F.col("pos"), F.col("context"), F.col("draw")))
    last = noise.agg(F.max("idx").alias("__last"))
    iv = (noise.crossJoin(F.broadcast(last))  # one-row aggregate
          .select(F.col("idx").alias("negative"), (F.col("cum") - F.col("prob")).alias("__lo"),
                  # the last interval is closed at 1 so rounding in the sum cannot lose a draw
                  F.when(F.col("idx") == F.col("__last"), F.lit(2.0)).otherwise(F.col("cum")).alias("__hi")))
    cells = iv.select("*", F.explode(F.sequence(
        F.floor(F.greatest(F.col("__lo"), F.lit(0.0)) * buckets).cast("long"),
        F.least(F.floor(F.col("__hi") * buckets), F.lit(buckets - 1)).cast("long"))).alias("__cell"))
    x = x.withColumn("__cell", F.least(F.floor(F.col("__u") * buckets), F.lit(buckets - 1)).cast("long"))
    j = x.join(cells, "__cell").filter((F.col("__u") >= F.col("__lo")) & (F.col("__u") < F.col("__hi")))
    return (j.drop("__cell", "__u", "__lo", "__hi")
            .filter(F.col("negative") != F.col("centre")))
