"""Operator 6: line deduplication with levelled sorted runs of line hashes.

A line's key is the line stripped of ASCII blanks and lower-cased (A-Z); keys of at least ``min_chars`` code points that
stand in at least ``min_docs`` documents lose all their lines except in the document with the largest id that holds them.

Documents come in batches of descending id.  ``LineRuns`` holds what earlier batches had: sorted runs of
(k1, k2, n_docs, holder), k1 and k2 being 128 bits of key hash.  Each batch is merge-joined with the runs: keys
they do not hold (the anti-join) enter as new entries with their largest id as holder, which no later
batch can beat; known keys enter as counts only.  The batch's entries become a run of level 0; ``fanout`` runs of a level are
compacted into one run of the next.  Runs are Parquet files in the shared checkpoint folder, so a lost executor costs a
task retry and lineage stays short.

A hot key is one entry per map task after partial aggregation; the last join, from (document, key) rows to frequent keys,
is a plain equi-join whose skewed partitions AQE splits, and texts are shuffled once, by id, with the list of dropped keys.

Defined cases: null or empty text is one empty line; every row counts as a document, and rows that share an id share their
dropped keys; rows with a null id are the lowest documents; an empty table gives no rows.
"""

from __future__ import annotations

from uuid import uuid4

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.text import BLANKS, LOWER, UPPER, ascii_lower
from tessera.session import ensure_checkpoint_dir

SEED = 42  # of Spark's xxhash64; the first half of a key is its plain xxhash64
# seed of the second half: Spark hashes column by column, so a constant before the key gives an own seed, one after it adds nothing
SEED2 = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), SEED)


def line_keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, k1, k2): one row per document and distinct key of at least ``min_chars`` code points."""
    lines = F.transform(F.split(ascii_lower(F.col(text_col)), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)))
    keys = F.array_distinct(F.filter(lines, lambda x: F.length(x) >= min_chars))
    return (docs.select(F.col(id_col).alias("id"), F.explode(keys).alias("key"))
            .select("id", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit(1), "key").alias("k2")))


class LineRuns:
    """Sorted runs of (k1, k2, n_docs, holder) in levels; a key has a holder in exactly one entry."""

    def __init__(self, spark, folder: str, fanout: int = 2):
        self.spark, self.folder, self.fanout = spark, folder, fanout
        self.levels: list[list[str]] = []

    def _write(self, level: int, entries: DataFrame) -> None:
        path = f"{self.folder}/level{level}-{uuid4().hex}"
        entries.sortWithinPartitions("k1", "k2").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)
        if len(self.levels[level]) == self.fanout:
            merged = self.totals(self.levels[level])
            self.levels[level] = []
            self._write(level + 1, merged)

    def paths(self) -> list[str]:
        return [p for level in self.levels for p in level]

    def totals(self, paths: list[str] | None = None) -> DataFrame:
        """All entries of a key as one."""
        return (self.spark.read.parquet(*(paths or self.paths())).groupBy("k1", "k2")
                .agg(F.sum("n_docs").alias("n_docs"), F.max("holder").alias("holder")))

    def add(self, batch: DataFrame) -> None:
        """Adds a batch of (id, k1, k2) whose ids are all smaller than those added before."""
        own = batch.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("holder"))
        if self.paths():
            known = (self.spark.read.parquet(*self.paths()).where(F.col("holder").isNotNull())
                     .select("k1", "k2", F.lit(True).alias("known")))
            own = own.join(known, ["k1", "k2"], "left").withColumn(
                "holder", F.when(F.col("known").isNull(), F.col("holder"))).drop("known")
        self._write(0, own)


def _signed(key: bytes, seed: int) -> int:
    h = xxhash.xxh64_intdigest(key, seed)
    return h - (1 << 64) if h >> 63 else h


def _keep(texts: pd.Series, drops: pd.Series) -> pd.DataFrame:
    lower = str.maketrans(UPPER, LOWER)
    kept, n = [], []
    for text, drop in zip(texts, drops):
        if drop is None:
            kept.append(None)
            n.append(0)
            continue
        halves = drop.tolist()
        first, gone = set(halves[::2]), set(zip(halves[::2], halves[1::2]))
        lines = text.split("\n")
        keys = [x.strip(BLANKS).translate(lower).encode() for x in lines]
        stay = [x for x, key in zip(lines, keys)
                if (k1 := _signed(key, SEED)) not in first or (k1, _signed(key, SEED2)) not in gone]
        kept.append("\n".join(stay))
        n.append(len(lines) - len(stay))
    return pd.DataFrame({"kept": kept, "n": n})


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20, min_docs: int = 3,
               batches: int = 3, fanout: int = 2) -> DataFrame:
    """The rows of ``docs`` with ``__n_lines``, ``__n_dropped`` and ``__kept``, the text that is left."""
    spark = docs.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/lines-{uuid4().hex}"
    cuts = docs.select(F.percentile_approx(id_col, [i / batches for i in range(1, batches)], 1000)).first()[0] or []
    batch = sum((F.coalesce((F.col("id") <= c).cast("int"), F.lit(1)) for c in sorted(set(cuts))), F.lit(0))
    line_keys(docs, id_col, text_col, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(f"{folder}/keys")
    schema = f"id {dict(docs.dtypes)[id_col]}, k1 long, k2 long, batch int"
    keys = spark.read.schema(schema).parquet(f"{folder}/keys")
    runs = LineRuns(spark, f"{folder}/runs", fanout)
    for b in range(len(set(cuts)) + 1):  # batch 0 has the largest ids
        runs.add(keys.where(F.col("batch") == b).drop("batch"))
    hot = runs.totals().where(F.col("n_docs") >= min_docs)
    drops = (keys.join(hot, ["k1", "k2"]).where(~F.col("id").eqNullSafe(F.col("holder")))
             .groupBy(F.col("id").alias("__key")).agg(F.flatten(F.collect_set(F.array("k1", "k2"))).alias("__drops")))
    rows = docs.withColumn("__key", F.col(id_col)).alias("d")
    joined = rows.join(drops.alias("x"), F.col("d.__key").eqNullSafe(F.col("x.__key")), "left").select("d.*", "x.__drops").drop("__key")
    keep = F.pandas_udf(_keep, "kept string, n long")
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = joined.withColumn("__r", keep(F.when(F.col("__drops").isNotNull(), text), F.col("__drops")))
    return (out.withColumn("__n_lines", F.size(F.split(text, "\n", -1)).cast("long"))
            .withColumn("__n_dropped", F.col("__r.n")).withColumn("__kept", F.coalesce(F.col("__r.kept"), text))
            .drop("__r", "__drops"))


ORACLE = r"""WITH l AS (
  SELECT doc_id, unnest(generate_series(1, len(ls))) AS pos, unnest(ls) AS line FROM (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
d AS (SELECT k.*, f.holder IS NOT NULL AND f.holder <> k.doc_id AS dropped FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM d GROUP BY doc_id"""
