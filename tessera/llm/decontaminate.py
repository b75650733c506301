"""Operator 1: benchmark decontamination by winnowing.  DataFrame functions only.

Texts become arrays of words.  The hashes of all k-grams are winnowed: of every ``w = window - k + 1`` consecutive
hashes the smallest (rightmost on ties) is kept as a fingerprint.  Any span of ``window`` words that a document shares
with an item contains the same ``w`` hashes on both sides, so both keep the same one: joining fingerprints finds every
shared span.  A hit is extended word by word to both sides, at most ``window - k`` words each way (each window of a longer
run has a fingerprint of its own); it counts when the verified run reaches ``window`` words.  An item with fewer words
than ``window`` is one window of its own length; for each such length that occurs (at most ``window - 1``)
the documents' grams of that length are looked up too.

A fingerprint packs 34 bits of hash and 30 bits of position into one long, so the window minimum is ``array_min`` over
longs and ties break by position; candidates are always verified on the words, hash collisions cost time, never rows.

Shuffles: fingerprints of documents meet those of the benchmark in a broadcast join while the latter number at most
``max_broadcast`` (counted first), beyond that in a shuffle join on the hash that carries the few context words.
Only verified hits and one row per document are shuffled by document.

Defined cases: null or wordless texts have 0 words and hits; a wordless item never occurs; rows that repeat both id and
text give one result row, rows that share an id with different texts one each; repeated items count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.text import add_gram_hashes, alnum_words, match_length, shifted

POS_BITS = 30
POS_MASK = (1 << POS_BITS) - 1


def _pack(grams: str) -> Column:
    """(hash, position) of every gram as one long; among equal hashes the later position is the smaller long."""
    return F.transform(grams, lambda h, i: h.bitwiseAND(F.lit(~POS_MASK)).bitwiseOR(F.lit(POS_MASK) - i))


def _salted(packed: str, salt: Column) -> Column:
    return F.transform(packed, lambda v: v.bitwiseXOR(salt))


def _fingerprints(df: DataFrame, window: int, k: int, short: list[int]) -> DataFrame:
    """Adds ``__win``, packed winnowed fingerprints, and ``__s{n}``, all packed n-grams, for every n of ``short``."""
    out = add_gram_hashes(df, "__words", "__win", k).withColumn("__win", _pack("__win"))
    w, have = window - k + 1, 1
    while have < w:  # the minimum over w neighbours from minima over fewer; at the end over those that are left
        step = min(have, w - have)
        out = out.withColumn("__win", F.zip_with("__win", shifted(F.col("__win"), step), lambda a, b: F.least(a, b)))
        have += step
    out = out.withColumn("__win", F.array_distinct("__win"))
    for n in short:
        out = add_gram_hashes(out, "__words", f"__s{n}", n).withColumn(f"__s{n}", _pack(f"__s{n}"))
        salt = F.lit(n << POS_BITS)  # grams of different lengths never meet
        out = out.withColumn(f"__s{n}", _salted(f"__s{n}", salt))
    return out


def _hash(v: Column) -> Column:
    return F.shiftright(v, POS_BITS)


def _start(v: Column) -> Column:
    return (F.lit(POS_MASK) - v.bitwiseAND(F.lit(POS_MASK))).cast("int")


def _context(p: Column, reach: Column, window: int) -> list[Column]:
    """Up to ``window`` words from ``p`` on, and up to ``reach`` words before it, nearest first."""
    left = F.least(p, reach)
    return [F.slice("__words", p + 1, window), F.reverse(F.slice("__words", p - left + 1, left))]


def shared_spans(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text: str = "text", window: int = 13, k: int = 6,
                 max_broadcast: int = 500_000) -> DataFrame:
    """Verified spans (__id, __tk, n_words, item, a, b): words [a, b) of the document stand in ``item``; every document also
    has one row with null item, which carries its number of words."""
    items = (bench.select(F.col(item_col).cast("string").alias("item"), alnum_words(F.col(item_text)).alias("__words"))
             .where(F.size("__words") > 0).distinct())
    short = sorted(r[0] for r in items.select(F.size("__words")).distinct().where(F.size("__words") < window).collect())
    entry = F.when(F.size("__words") >= window, F.col("__win"))
    for n in short:
        entry = entry.when(F.size("__words") == n, F.col(f"__s{n}"))
    whole = F.size("__words") >= window
    onward, back = _context(_start(F.col("v")), F.when(whole, window - k).otherwise(0), window)
    prints = (_fingerprints(items, window, k, short).select("item", "__words", F.explode(entry).alias("v"))
              .select(_hash(F.col("v")).alias("h"), "item", F.least(F.size("__words"), F.lit(window)).alias("need"),
                      onward.alias("i_onward"), back.alias("i_back")))
    small = prints.limit(max_broadcast + 1).count() <= max_broadcast

    texts = docs.select(F.col(id_col).alias("__id"), F.xxhash64(F.col(text_col)).alias("__tk"),
                        alnum_words(F.col(text_col)).alias("__words"))
    # one extra null entry per document keeps documents without hits and carries the word count
    entries = F.concat(F.array(F.lit(None).cast("long")), F.col("__win"), *[F.col(f"__s{n}") for n in short])
    grams = _fingerprints(texts, window, k, short).select("__id", "__tk", "__words", F.explode(entries).alias("v"))
    real = F.col("v").isNotNull()
    onward, back = _context(_start(F.col("v")), F.lit(window - k), window)
    context = [F.when(real, onward).alias("d_onward"), F.when(real, back).alias("d_back")]
    n_words = F.when(~real, F.size("__words")).alias("n_words")
    if small:
        found = (grams.withColumn("h", _hash(F.col("v"))).join(F.broadcast(prints), "h", "left")
                 .where(~real | F.col("item").isNotNull())
                 .select("__id", "__tk", "v", n_words, "item", "need", "i_onward", "i_back", *context))
    else:
        found = (grams.where(real).select("__id", "__tk", "v", _hash(F.col("v")).alias("h"), *context).join(prints, "h").drop("h")
                 .unionByName(grams.where(~real).select("__id", "__tk", "v", n_words), allowMissingColumns=True))
    # verification is a generator: the join above stays a small compiled loop, and only its few matches come here
    r = match_length(F.col("d_onward"), F.col("i_onward"))
    l = match_length(F.col("d_back"), F.col("i_back"))
    span = F.struct(F.col("item"), (_start(F.col("v")) - l).alias("a"), (_start(F.col("v")) + r).alias("b"))
    none = F.struct(F.lit(None).cast("string").alias("item"), F.lit(None).cast("int").alias("a"), F.lit(None).cast("int").alias("b"))
    verified = F.when(~real, F.array(none)).when((r >= F.least(F.lit(k), F.col("need"))) & (l + r >= F.col("need")), F.array(span))
    return found.select("__id", "__tk", "n_words", F.inline(verified))


def contamination(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """Per document: (id, n_words, n_hit, n_items, items_sha256, contaminated, __tk), ``__tk`` the hash of the text."""
    spans = shared_spans(docs, bench, id_col, text_col, **kw)
    w = Window.partitionBy("__id", "__tk").orderBy("a", "b")
    seen = F.coalesce(F.max("b").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = F.greatest(F.lit(0), F.col("b") - F.greatest(F.col("a"), seen))
    n_hit = F.coalesce(F.sum("__fresh"), F.lit(0))
    return (spans.withColumn("__fresh", fresh).groupBy("__id", "__tk")
            .agg(F.max("n_words").cast("long").alias("n_words"), n_hit.cast("long").alias("n_hit"),
                 F.array_sort(F.collect_set("item")).alias("items"))
            .select(F.col("__id").alias(id_col), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                    ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "__tk"))


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns unchanged."""
    bad = (contamination(docs, bench, id_col, text_col, **kw).where("contaminated")
           .select(F.col(id_col).alias("__bad_id"), F.col("__tk").alias("__bad_tk")))
    return docs.join(bad, docs[id_col].eqNullSafe(F.col("__bad_id"))
                     & (F.xxhash64(docs[text_col]) == F.col("__bad_tk")), "left_anti")


ORACLE = r"""WITH dw AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
bw AS (
  SELECT cast(item_id AS varchar) AS item, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bg AS (SELECT DISTINCT item, least(len(w), 13) AS n, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1),
    lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS g FROM bw WHERE len(w) > 0),
ns AS (SELECT DISTINCT n FROM bg),
dg AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS p,
    unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS g
  FROM dw, ns WHERE len(w) >= n),
hits AS (SELECT doc_id, item, p, n FROM dg JOIN bg USING (n, g)),
cov AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (
    SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (
    SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)"""
