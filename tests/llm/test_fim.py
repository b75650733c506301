"""Fill-in-middle against a plain list of lines, and the exact round trip."""
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import fim

LINES = re.compile(r"[^\n]*\n|[^\n]+")


def brute(key, text, rate=100, spm=50):
    units = LINES.findall(text)
    h = hashlib.sha256(f"7:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return len(units), "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return len(units), "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def texts():
    rng = random.Random(4)
    yield from ["", "\n", "\n\n\n", "a", "a\n", "\na", "é\U0001f600\n\nß", "<P>", "x <S> y\nz", "a<M", "<\n<P\nS>\n<", "x" * 70_000, "y\n" * 30_000,
                "\r\n\x0b\x85  no line feed"]
    for _ in range(300):
        yield "".join(rng.choice("ab\n\n<é") for _ in range(rng.randrange(60)))


@pytest.mark.parametrize("block", [1, 2, 7, 64, 4096])
def test_transform_matches_a_list_of_lines(block):
    for i, text in enumerate(texts()):
        if block < 7 and len(text) > 1000:
            continue
        got = fim.transform(str(i), text, block=block)
        assert got == brute(i, text)
        assert fim.restore(got[4], got[1]) == text


def test_every_cut_of_a_tree():
    rng = random.Random(5)
    for block in (1, 3, 8):
        for _ in range(60):
            text = "".join(rng.choice("ab\n") for _ in range(rng.randrange(40)))
            tree, units = fim.BlockTree(text, block), LINES.findall(text)
            assert tree.n == len(units)
            assert [tree.cut(k) for k in range(tree.n + 1)] == [len("".join(units[:k])) for k in range(tree.n + 1)]


def test_rates():
    forms = [fim.transform(str(i), "a\nb", rate=40, spm=10)[1] for i in range(2000)]
    assert forms == [brute(i, "a\nb", 40, 10)[1] for i in range(2000)]
    assert 0.55 < forms.count("plain") / 2000 < 0.65 and forms.count("spm") < forms.count("psm") / 5


def test_broken_output_is_an_error():
    for output, form in (("prefix<S>s<M>m", "psm"), ("<P>p<M>m", "psm"), ("<S>s<P>p", "spm")):
        with pytest.raises(ValueError):
            fim.restore(output, form)


def test_frame_nulls_repeats_clashing_columns_and_empty(spark):
    rows = list(enumerate(texts())) + [((1 << 62) + 1, "a\nb"), (None, "a\nb\n"), (3, "a"), (900, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("id", "key", "n", "form", "output", "restored", "prefix_chars"):
        docs = docs.withColumn(name, F.lit(1))
    got = fim.restored(fim.fill_in_middle(docs)).collect()
    want = sorted(((i, *brute("" if i is None else i, t or ""), t or "") for i, t in rows), key=str)
    assert sorted((tuple(r) for r in got), key=str) == want
    named = docs.select(F.col("doc_id").cast("string").alias("name"), F.col("text").alias("body"))
    assert dict(fim.fill_in_middle(named, "name", "body").dtypes)["name"] == "string"
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
