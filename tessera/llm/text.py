"""Column expressions shared by the text operators: tokens, k-gram hashes, interval unions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the contracts.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # separators between alphanumeric words
BLANK = r"[\x20\x09-\x0D]+"  # separators between blank-delimited words
BLANKS = " \t\n\x0b\x0c\r"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else; null counts as empty.  ``lower`` is the cheaper way where all characters are ASCII."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def alnum_words(text: Column) -> Column:
    """Lower-cased words of letters, digits and non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(text), NON_WORD, -1), "")


def blank_words(text: Column) -> Column:
    """Lower-cased words between ASCII blanks."""
    return F.array_remove(F.split(ascii_lower(text), BLANK, -1), "")


def shifted(a: Column, by: int) -> Column:
    """``a`` without its first ``by`` elements."""
    return F.slice(a, by + 1, F.size(a))


def add_gram_hashes(df: DataFrame, words: str, out: str, k: int) -> DataFrame:
    """Adds ``out``: 64-bit hashes of all k-grams of the array ``words``, in order of their start.

    Longer grams are hashed from two shorter, overlapping ones, so the cost per word is a few hashes of two longs.
    """
    df = df.withColumn(out, F.transform(words, lambda w: F.xxhash64(w)))
    have = 1
    while have < k:
        step = min(have, k - have)
        df = df.withColumn(out, F.zip_with(out, shifted(F.col(out), step), lambda a, b: F.xxhash64(a, b)))
        have += step
    # past the last whole gram only partial ones are left
    return df.withColumn(out, F.slice(out, 1, F.greatest(F.size(out) - (k - 1), F.lit(0))))


def match_length(a: Column, b: Column) -> Column:
    """Number of leading positions at which two arrays hold the same value."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    miss = F.array_position(same, False)
    return F.when(miss == 0, F.size(same)).otherwise(miss - 1).cast("int")
