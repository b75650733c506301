"""Operator 12: fill-in-middle transformation of whole documents.

A document is cut at two line boundaries into prefix, middle and suffix, drawn from its id alone, and written with sentinels:
``psm`` is <P>prefix<S>suffix<M>middle, ``spm`` is <S>suffix<P>prefix<M>middle, ``plain`` is the text itself.

Units are lines, each with its line feed.  A text is cut into fixed blocks of ``block`` code points; a Fenwick tree over the blocks
holds their line feeds and code points.  The place after k units is found by binary-lifting descent: the tree's
largest steps that stay below k line feeds lead to the block of the k-th one in log2(blocks) steps, and a search inside that block
gives the boundary.  No list of lines is built, so memory is the text and two numbers a block.

Every row is transformed by itself in Arrow batches: no shuffle, and a lost task is repeated with the same draws.

Defined cases: a null text is empty; an empty text, and one that contains a sentinel, is plain; a null id draws like the empty
string; a text of one line may have an empty prefix, middle or suffix; rows that repeat an id get the same draws and, for
equal texts, the same output; an empty table gives no rows.  Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
SEED = 7

OUT = "n long, form string, prefix_chars long, middle_chars long, output string"


class BlockTree:
    """Line feeds and code points of a text's blocks in a Fenwick tree: entry i sums the blocks (i - lowbit(i), i]."""

    def __init__(self, text: str, block: int):
        self.text = text
        blocks = -(-len(text) // block)
        feeds = np.fromiter((text.count("\n", i * block, (i + 1) * block) for i in range(blocks)), "int64", blocks)
        chars = np.full(blocks, block, "int64")
        if blocks:
            chars[-1] = len(text) - (blocks - 1) * block
        self.units = self._tree(feeds)
        self.chars = self._tree(chars)
        self.feeds = int(feeds.sum())
        #: units of the text: its lines, the last one with or without a line feed
        self.n = self.feeds + (1 if text and text[-1] != "\n" else 0)

    @staticmethod
    def _tree(values: np.ndarray) -> list[int]:
        sums = np.concatenate(([0], np.cumsum(values)))
        at = np.arange(1, len(values) + 1)
        return [0, *(sums[at] - sums[at - (at & -at)]).tolist()]

    def cut(self, k: int) -> int:
        """Code points of the first ``k`` units."""
        if k <= 0:
            return 0
        if k > self.feeds:  # past the last line feed: the whole text
            return len(self.text)
        node, units, chars = 0, 0, 0
        step = 1 << (len(self.units) - 1).bit_length()
        while step:
            there = node + step
            if there < len(self.units) and units + self.units[there] < k:
                node, units, chars = there, units + self.units[there], chars + self.chars[there]
            step >>= 1
        # block ``node`` (from 0) holds the k-th line feed
        at = chars - 1
        for _ in range(k - units):
            at = self.text.index("\n", at + 1)
        return at + 1


def draws(doc_id: str, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of an id."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12))


def transform(doc_id: str, text: str, rate: int = 100, spm: int = 50, block: int = 4096, seed: int = SEED):
    """(n, form, prefix_chars, middle_chars, output) of one document."""
    tree = BlockTree(text, block)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or any(s in text for s in SENTINELS):
        return tree.n, "plain", None, None, text
    low, high = sorted((h1 % (tree.n + 1), h2 % (tree.n + 1)))
    a, b = tree.cut(low), tree.cut(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm:
        return tree.n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return tree.n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def restore(output: str, form: str) -> str:
    """The text from its transformed form; a sentinel that does not stand where the form has it is a ValueError.

    Sentinels have no proper prefix that is also a suffix, so the first occurrence is the written one whatever stands around it.
    """
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(first):
        raise ValueError(f"no {first} at the start of a {form} text")
    one, rest = output[len(first):].split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    prefix, suffix = (one, two) if form == "psm" else (two, one)
    return prefix + middle + suffix


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = 100, spm: int = 50,
                   block: int = 4096, seed: int = SEED) -> DataFrame:
    """Per row: (id, n, form, prefix_chars, middle_chars, output).

    ``rate`` and ``spm`` are percentages: documents that are transformed, and those of them with the suffix first.
    """
    def run(keys: pd.Series, texts: pd.Series) -> pd.DataFrame:
        rows = [transform(key, text, rate, spm, block, seed) for key, text in zip(keys, texts)]
        out = pd.DataFrame(rows, columns=["n", "form", "prefix_chars", "middle_chars", "output"])
        return out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    udf = F.pandas_udf(run, OUT)
    made = udf(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col), F.lit("")))
    return docs.select(F.col(id_col), made.alias("r")).select(F.col(id_col), "r.*")


def restored(forms: DataFrame, out: str = "restored") -> DataFrame:
    """Adds the text that (form, output) stand for."""
    def texts(output: pd.Series, form: pd.Series) -> pd.Series:
        return pd.Series([restore(o, f) for o, f in zip(output, form)], dtype="object")

    return forms.withColumn(out, F.pandas_udf(texts, "string")("output", "form"))


ORACLE = r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
  sha256('7:' || coalesce(cast(doc_id AS varchar), '')) AS h FROM documents),
d AS (SELECT *, len(u) AS n, cast('0x' || substr(h, 1, 8) AS bigint) % (len(u) + 1) AS a,
  cast('0x' || substr(h, 9, 8) AS bigint) % (len(u) + 1) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
    OR cast('0x' || substr(h, 17, 8) AS bigint) % 100 >= 100 THEN 'plain'
    WHEN cast('0x' || substr(h, 25, 8) AS bigint) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT *, array_to_string(u[1:least(a, b)], '') AS pre, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS mid,
  array_to_string(u[greatest(a, b) + 1:], '') AS suf FROM d)
SELECT doc_id, cast(n AS bigint) AS n, form, CASE WHEN form <> 'plain' THEN cast(length(pre) AS bigint) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN cast(length(mid) AS bigint) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(pre || mid || suf) AS restored_sha256
FROM p"""
