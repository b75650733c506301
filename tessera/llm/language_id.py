"""Operator 8: language identification by segmentation-marginalised unigrams.

A fixed public vocabulary of pieces gives every language a unigram distribution over pieces.  The probability of a word is
the sum over all its segmentations into pieces, which the forward algorithm adds up from left to right; a text is a bag of
words, its language the one with the largest probability (equal priors).

Training: at most ``sample`` labelled documents per language (smallest hash of id first) count words per language, in
Spark; a few rounds of expectation-maximisation (forward-backward over all segmentations) fit the piece
probabilities.  The model is (vocabulary x languages) numbers, whatever the corpus.  The bound on the sample is the only one:
whole texts are used, and every document is scored.

Scoring is one pass over the documents, without a shuffle: each worker scores a distinct word once and keeps the result in a
cache of at most ``CACHE`` words, which is emptied when full; new words of one length are scored together.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is everything when no labelled text has a
letter; repeated rows are rows like others; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# \w has letters, decimal digits and the underscore, but also other numbers (superscripts, fractions, circled digits), which are no
# letters: the few words that hold one are cut there
WORD = re.compile(r"[^\W\d_]+")


def letters(word: str):
    """Runs of letters in a word."""
    return "".join(c if c.isalpha() else " " for c in word).split()


CACHE = 400_000
LONGEST = 40  # words beyond this many characters are scored as consecutive words of this length
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def words_of(text: str):
    for w in WORD.findall(text.lower()):
        if len(w) <= LONGEST and w.isalpha():
            yield w
        else:
            for run in letters(w):
                yield from (run[i:i + LONGEST] for i in range(0, len(run), LONGEST))


def load_pieces(path: str) -> list[str]:
    """The vocabulary's pieces that are made of letters, lower case, without duplicates; a leading mark tells word starts."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = dict.fromkeys(sp.id_to_piece(i).lower() for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i)))
    return [p for p in pieces if p.removeprefix("▁").isalpha()]


class Lattice:
    """Pieces by text, and the segmentation lattices of many words of one length at once."""

    def __init__(self, pieces: list[str]):
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)

    def edges(self, words: list[str]) -> list[tuple[int, int, np.ndarray]]:
        """(from, to, piece of every word) in order of ``to``.  Behind the pieces stand two more numbers: no such edge, and a
        character that is no piece, which is an edge of its own."""
        get, none, out = self.ids.get, len(self.ids), []
        for end in range(1, len(words[0]) + 1):
            for start in range(max(0, end - self.longest), end):
                plain = np.array([get(w[start:end], none) for w in words])
                marked = np.array([get("▁" + w[:end], none) for w in words]) if start == 0 else None
                if end == start + 1:
                    unknown = plain == none
                    if marked is not None:
                        unknown &= marked == none
                    plain[unknown] = none + 1
                out += [(start, end, p) for p in (plain, marked) if p is not None and (p != none).any()]
        return out


def extended(prob: np.ndarray, floor: float) -> np.ndarray:
    """``prob``, nowhere below ``floor``, with the probabilities of "no edge" and of a character that is no piece.  So no word of
    LONGEST characters has a probability below floor ** LONGEST, which a double still holds."""
    return np.vstack([np.maximum(prob, floor), np.zeros((1, prob.shape[1])), np.full((1, prob.shape[1]), floor)])


def forward(edges, size: int, n: int, prob: np.ndarray) -> np.ndarray:
    """Sum over segmentations at every position: (position, word, language)."""
    alpha = np.zeros((n + 1, size, prob.shape[1]))
    alpha[0] = 1.0
    for start, end, piece in edges:
        alpha[end] += alpha[start] * prob[piece]
    return alpha


def by_length(words, at_most: int = 8192):
    """Lists of at most ``at_most`` words of one length."""
    words = sorted(words, key=len)
    for _, group in groupby(words, len):
        group = list(group)
        yield from (group[i:i + at_most] for i in range(0, len(group), at_most))


def word_scores(words: list[str], lattice: Lattice, prob: np.ndarray, floor: float) -> np.ndarray:
    """log probability of words of one length: (word, language)."""
    return np.log(forward(lattice.edges(words), len(words), len(words[0]), extended(prob, floor))[-1])


def fit(counts: dict[str, np.ndarray], lattice: Lattice, n_langs: int, rounds: int, smooth: float, floor: float) -> np.ndarray:
    """Piece probabilities per language from word counts per language, by expectation-maximisation."""
    size = len(lattice.ids)
    prob = np.full((size, n_langs), 1.0 / max(size, 1))
    for _ in range(rounds):
        known = extended(prob, floor)
        expected = np.zeros_like(known)
        for words in by_length(counts):
            edges, n = lattice.edges(words), len(words[0])
            alpha = forward(edges, len(words), n, known)
            beta = np.zeros_like(alpha)
            beta[n] = 1.0
            for start, end, piece in reversed(edges):
                beta[start] += beta[end] * known[piece]
            share = np.array([counts[w] for w in words]) / alpha[n]
            for start, end, piece in edges:
                np.add.at(expected, piece, share * alpha[start] * known[piece] * beta[end])
        prob = expected[:size] + smooth
        prob /= prob.sum(axis=0)
    return prob


def _sample_words(batches):
    for pdf in batches:
        counts: Counter = Counter()
        for text, lang in zip(pdf["text"], pdf["lang"]):
            counts.update((lang, w) for w in words_of(text))
        yield pd.DataFrame({"lang": [k[0] for k in counts], "word": [k[1] for k in counts], "n": list(counts.values())})


class LanguageModel:
    """Languages, vocabulary and piece probabilities; ``predict`` adds lang_pred and score."""

    def __init__(self, langs: list[str], pieces: list[str], prob: np.ndarray, floor: float):
        self.langs, self.pieces, self.prob, self.floor = langs, pieces, prob, floor

    def predict(self, docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
        """Columns ``keep`` with lang_pred and score; columns of ``docs`` with these names are replaced."""
        keep = [c for c in docs.columns if c not in ("lang_pred", "score")] if keep is None else keep
        model = docs.sparkSession.sparkContext.broadcast((self.langs, self.pieces, self.prob.astype("float32"), self.floor))

        def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            langs, pieces, prob, floor = model.value
            prob, lattice = prob.astype("float64"), Lattice(pieces)
            room = max(1000, min(CACHE, 4 * CACHE // max(1, len(langs))))
            rows: dict[str, int] = {}  # word to row of scores
            scores = np.zeros((room, len(langs)), "float32")
            for texts in batches:
                pred, best = [], []
                for lo in range(0, len(texts), 500):
                    bags = [Counter(words_of(t or "")) for t in texts.iloc[lo:lo + 500]]
                    new = {w for bag in bags for w in bag if w not in rows} if langs else set()
                    if len(rows) + len(new) > room:
                        rows.clear()
                        new = {w for bag in bags for w in bag}
                        if len(new) > len(scores):
                            scores = np.zeros((len(new), len(langs)), "float32")
                    for group in by_length(new):
                        first = len(rows)
                        scores[first:first + len(group)] = word_scores(group, lattice, prob, floor)
                        rows.update(zip(group, range(first, first + len(group))))
                    for bag in bags:
                        if not bag or not langs:
                            pred.append("und")
                            best.append(0.0)
                            continue
                        total = np.fromiter(bag.values(), "float64", len(bag)) @ scores[np.fromiter(map(rows.__getitem__, bag), int, len(bag))]
                        top = int(total.argmax())
                        pred.append(langs[top])
                        best.append(float(1.0 / np.exp(total - total[top]).sum()))
                yield pd.DataFrame({"lang_pred": pred, "score": best})

        udf = F.pandas_udf(score, "lang_pred string, score double")
        names = [f"k{i}" for i in range(len(keep))]  # whatever the columns are called
        out = docs.select(*[F.col(k).alias(n) for k, n in zip(keep, names)], udf(F.col(text_col)).alias("p"))
        return out.select(*[F.col(n).alias(k) for n, k in zip(names, keep)], "p.lang_pred", "p.score")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", vocabulary: str = VOCABULARY,
          sample: int = 100, rounds: int = 2, smooth: float = 0.01, floor: float = 1e-7) -> LanguageModel:
    """Learns from the rows of ``docs`` that have text and language, at most ``sample`` of each language."""
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    order = Window.partitionBy("lang").orderBy("h", "id")
    ids = (labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col)).alias("h"))
           .withColumn("r", F.row_number().over(order)).where(F.col("r") <= sample).select("id", "lang"))
    chosen = labelled.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).join(
        F.broadcast(ids), ["id", "lang"], "left_semi")  # at most sample x languages ids
    rows = (chosen.mapInPandas(_sample_words, "lang string, word string, n long").groupBy("lang", "word")
            .agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(rows["lang"].unique())
    at = {lang: i for i, lang in enumerate(langs)}
    counts: dict[str, np.ndarray] = {}
    for lang, word, n in rows.itertuples(index=False):
        counts.setdefault(word, np.zeros(len(langs)))[at[lang]] = n
    pieces = load_pieces(vocabulary)
    if not langs:
        return LanguageModel([], pieces, np.zeros((len(pieces), 0)), floor)
    return LanguageModel(langs, pieces, fit(counts, Lattice(pieces), len(langs), rounds, smooth, floor), floor)


def held_out(id_col: str = "doc_id"):
    """Documents that are never learned from."""
    return F.crc32(F.col(id_col).cast("string")) % 5 == 0
