"""Operator 3: personal data by fixed patterns and a skip-chain conditional random field.

Base spans come from the patterns of the contract, over every whole text, each kind left to right without overlaps.  The search
is linear in the text: e-mails are found from their ``@``, digits from the start of a run.

The field labels tokens with a kind or none.  A token that holds neither a digit nor ``@`` is clamped to none, which cuts the chain
there; so the variables of a document are its tokens with digits or ``@``, neighbours in the text share a transition
potential, and tokens with the same digits, or the same letters when they hold ``@``, share a skip potential wherever they
stand.  Each token gets the log messages of all its equals: a group's are summed once and each token takes the sum without its
own, so a token that occurs thousands of times costs no pairs.  Sum-product messages are passed on this loopy graph for a fixed number of rounds, and tokens whose marginal of a
kind exceeds ``threshold`` add spans of that kind, neighbours of one kind as one span.  Base spans are never changed: added
spans that touch a base span are left out.

Training: on at most ``sample`` documents (smallest hash of id first) the base spans are the labels.  The unary weights over token
features and the transition and skip potentials are those of the pseudo-likelihood, by gradient descent with the labels
of all other tokens given; the skip potential, one for every edge, is learned from the share of a token's mates that have its label, so
that a few large groups do not decide it (in groups of two, the usual ones, that is the same).  Labels, features and rounds are fixed, so the model is a few hundred numbers.

Scoring is one pass over the documents without a shuffle.

Defined cases: null texts are empty and have no spans; repeated rows are rows like others; an empty table gives no rows, and with
nothing to learn from only base spans are returned.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone"]
NONE = len(KINDS)

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[^0-9]")
MARK = re.compile(r"[0-9@]")
BLANK = re.compile(r"[\x20\x09-\x0D]")
EDGES = "()[]{}<>,;:!?\"'."


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the contract's patterns, sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in CARD.finditer(text):
        digits = DIGITS.sub("", m.group())
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(DIGITS.sub("", m.group())) <= 15]
    return sorted(out)


def spell(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def tokens(text: str) -> list[tuple[int, int]]:
    """Spans of the tokens that hold a digit or @, without punctuation at their edges."""
    out, done = [], 0
    while m := MARK.search(text, done):
        a = m.start()
        while a > done and not BLANK.match(text[a - 1]):
            a -= 1
        blank = BLANK.search(text, m.end())
        done = b = blank.start() if blank else len(text)
        while a < b and text[a] in EDGES:
            a += 1
        while b > a and text[b - 1] in EDGES:
            b -= 1
        out.append((a, b))
    return out


def features(text: str, a: int, b: int) -> list[int]:
    """Indices into the feature table: shape of the token and of what stands around it."""
    t = text[a:b]
    n = sum(c.isdigit() for c in t)
    shape = (("@" in t) * 1 + (t.startswith("+") or text[max(0, a - 1):a] == "+") * 2 + (t.count(".") == 3) * 4 + any(c.isalpha() for c in t) * 8)
    after = t.partition("@")[2]
    closing = (("-" in t) * 1 + ("(" in text[max(0, a - 1):a] or ")" in text[b:b + 1]) * 2 + ("." in after) * 4 + (n == len(t)) * 8)
    return [0, 1 + min(n, 19), 21 + shape, 37 + closing, 53 + min(len(t), 15)]


N_FEATURES = 69


class Graph:
    """The variables of a document, their features, chain edges and groups of equal tokens."""

    def __init__(self, text: str):
        self.spans = tokens(text)
        self.x = np.array([features(text, a, b) for a, b in self.spans], dtype=int).reshape(-1, 5)
        # neighbours: nothing but punctuation and blanks between two tokens
        self.chain = [i for i in range(len(self.spans) - 1)
                      if self.spans[i + 1][0] - self.spans[i][1] <= 4 and not re.search(r"[^\W_]|\n", text[self.spans[i][1]:self.spans[i + 1][0]])]
        groups: dict[str, list[int]] = {}
        for i, (a, b) in enumerate(self.spans):
            t = text[a:b]
            groups.setdefault(t.lower() if "@" in t else DIGITS.sub("", t), []).append(i)
        self.group = np.zeros(len(self.spans), int)
        self.group_sizes = np.array([len(g) for g in groups.values()])
        for g, members in enumerate(groups.values()):
            self.group[members] = g

    def labels(self, spans) -> np.ndarray:
        """Label of every token: the kind of the base span that it overlaps."""
        y, at = np.full(len(self.spans), NONE), 0
        for i, (a, b) in enumerate(self.spans):
            while at < len(spans) and spans[at][2] <= a:
                at += 1
            if at < len(spans) and spans[at][0] < b:
                y[i] = spans[at][1]
        return y


def _softmax(z):
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


class Field:
    """Potentials: unary (feature x label), transition (label x label), skip (one number for equal labels)."""

    def __init__(self):
        self.unary = np.zeros((N_FEATURES, NONE + 1))
        self.step = np.zeros((NONE + 1, NONE + 1))
        self.skip = 0.0

    def fit(self, texts: list[str], rounds: int = 200, rate: float = 0.5, decay: float = 1e-3) -> "Field":
        """Pseudo-likelihood: each token given the labels of its neighbours and of its equals."""
        xs, ys, left, right, mates = [], [], [], [], []
        for text in texts:
            g = Graph(text)
            if not g.spans:
                continue
            y = g.labels(base_spans(text))
            one = np.eye(NONE + 1)[y]
            before, after = np.zeros_like(one), np.zeros_like(one)
            for i in g.chain:
                before[i + 1], after[i] = one[i], one[i + 1]
            sums = np.zeros((len(g.group_sizes), NONE + 1))
            np.add.at(sums, g.group, one)
            others = (sums[g.group] - one) / np.maximum(g.group_sizes[g.group] - 1, 1)[:, None]
            xs.append(g.x), ys.append(y), left.append(before), right.append(after), mates.append(others)
        if not xs:
            return self
        x, y, before, after, others = map(np.concatenate, (xs, ys, left, right, mates))
        want, n = np.eye(NONE + 1)[y], len(y)
        # labels are rare: each class has the same weight in total, none twice that
        weight = np.where(y == NONE, 2.0, 1.0) / np.maximum(np.bincount(y, minlength=NONE + 1), 1)[y]
        weight /= weight.sum()
        for _ in range(rounds):
            z = self.unary[x].sum(axis=1) + before @ self.step + after @ self.step.T + self.skip * others
            err = (want - _softmax(z)) * weight[:, None]
            grad = np.zeros_like(self.unary)
            for f in range(x.shape[1]):
                np.add.at(grad, x[:, f], err)
            self.unary += rate * 10 * grad - decay * self.unary
            self.step += rate * 10 * (before.T @ err + err.T @ after) - decay * self.step
            self.skip = max(0.0, self.skip + rate * 10 * float((err * others).sum()) - decay * self.skip)
        return self

    def marginals(self, g: Graph, rounds: int = 3) -> np.ndarray:
        """Loopy sum-product: chain messages both ways, and one skip message from each other member of a token's group.

        A member's skip message, 1 + (e^skip - 1) belief, is that of its beliefs without skip messages, so it is the same for all
        its mates: the log messages of a group are summed once, and each token takes the sum without its own.
        """
        unary = self.unary[g.x].sum(axis=1)
        forth, back = np.zeros_like(unary), np.zeros_like(unary)  # log messages that arrive from the left and from the right
        skip = np.zeros_like(unary)
        pairs = np.array(g.chain, int)
        push = np.exp(self.step)
        for _ in range(rounds):
            if len(pairs):
                out = np.log(_softmax(unary + forth + skip)[pairs] @ push)
                back_out = np.log(_softmax(unary + back + skip)[pairs + 1] @ push.T)
                forth[pairs + 1], back[pairs] = out, back_out
            belief = _softmax(unary + forth + back)
            message = np.log1p(np.expm1(self.skip) * belief)
            sums = np.zeros((len(g.group_sizes), NONE + 1))
            np.add.at(sums, g.group, message)
            skip = sums[g.group] - message
        return _softmax(unary + forth + back + skip)

    def added(self, text: str, base, threshold: float) -> list[tuple[int, int, int]]:
        """Spans of the field that touch no base span."""
        g = Graph(text)
        if not g.spans:
            return []
        p = self.marginals(g)
        best = np.where(p[:, :NONE].max(axis=1) >= threshold, p[:, :NONE].argmax(axis=1), NONE)
        chained, out = set(g.chain), []
        for i, (a, b) in enumerate(g.spans):
            if best[i] == NONE:
                continue
            if out and i - 1 in chained and best[i - 1] == best[i]:
                out[-1] = (out[-1][0], out[-1][1], b)
            else:
                out.append((a, int(best[i]), b))
        taken = sorted((a, b) for a, _, b in base)
        free, at = [], 0
        for a, k, b in out:
            while at < len(taken) and taken[at][1] <= a:
                at += 1
            if at == len(taken) or taken[at][0] >= b:
                free.append((a, k, b))
        return free


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = 1000) -> Field:
    """Learns from at most ``sample`` documents that hold an @ or a digit."""
    useful = docs.where(F.col(text_col).rlike("[0-9@]"))
    rows = (useful.select(F.xxhash64(id_col).alias("h"), F.col(id_col).alias("id"))
            .orderBy("h", "id").limit(sample))
    chosen = useful.join(F.broadcast(rows.select(F.col("id").alias("__id")).distinct()), F.col(id_col) == F.col("__id"), "left_semi")
    return Field().fit([r[0] for r in chosen.orderBy(F.xxhash64(id_col), id_col).select(text_col).limit(sample).collect()])


def find_pii(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.9) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base, spans): base and all spans as kind:start:end, comma-joined."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        trained = bool(model.unary.any())
        for texts in batches:
            out = []
            for text in texts:
                text = text or ""
                base = base_spans(text)
                more = model.added(text, base, threshold) if trained else []
                counts = [0] * NONE
                for _, k, _ in base:
                    counts[k] += 1
                out.append((*counts, spell(base), spell(sorted(base + more))))
            yield pd.DataFrame(out, columns=["n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    udf = F.pandas_udf(scan, "n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
    return docs.select(F.col(id_col), udf(F.col(text_col)).alias("r")).select(id_col, "r.*")
