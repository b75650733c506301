"""Operator 7: mixing sources to target weights by Pfair scheduling.  DataFrame functions only.

The stream is a sequence of slots of ``block`` rows.  Block j of a source with weight w out of W is released at slot
floor(j W / w) and due by slot ceil((j + 1) W / w); in each slot the released block with the earliest deadline goes.  All
windows are met, so while no source is exhausted every source has at any time less than one block more or
less than its share.  At slot W all sources are even again: the schedule is periodic, and one period (``period``, W
slots) places any number of blocks by arithmetic.

Rows are put in the order of a hash of their id within a source.  A rank within a hot source must not need one task: the
hash space is cut into buckets, counts per (source, bucket) give offsets, and only the rank inside a bucket is a
window.  Rows move once, by (source, bucket).  Every row is placed exactly once; an exhausted source leaves its
slots empty, and ``on_target`` tells the slots before the first such slot.

Defined cases: a null source is a source like others; rows that repeat an id are rows like others; an empty table gives no
rows; W grows to two slots a source where ``total`` is less, so any number of sources is mixed (the schedule, one row a
source and W slots, is made on the driver and broadcast up to BROADCAST_SLOTS).  Other columns may have any name.
"""

from __future__ import annotations

import math
from heapq import heapify, heappop, heappush

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


PER_SOURCE = 2
BROADCAST_SLOTS = 1_000_000  # 8 bytes each
ADDED = ("mix_weight", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_pos", "on_target")


def quantise(sizes: list[float], total: int) -> list[int]:
    """Whole weights of at least 1 that add up to ``total``, by largest remainder."""
    spare, whole = total - len(sizes), sum(sizes)
    exact = [x / whole * spare for x in sizes]
    out = [1 + math.floor(x) for x in exact]
    rest = sorted(range(len(sizes)), key=lambda i: (math.floor(exact[i]) - exact[i], i))
    for i in rest[:total - sum(out)]:
        out[i] += 1
    return out


def period(weights: list[int]) -> list[list[int]]:
    """For every source the slots of its blocks in one period of ``sum(weights)`` slots: released blocks, earliest deadline
    first, ties to the earlier source.  Two heaps, so a slot costs the logarithm of the number of sources."""
    total = sum(weights)
    slots: list[list[int]] = [[] for _ in weights]
    later, ready = [(0, s) for s in range(len(weights))], []  # blocks by release, and released ones by deadline
    heapify(later)
    for t in range(total):
        while later and later[0][0] <= t:
            s = heappop(later)[1]
            heappush(ready, (-(-(len(slots[s]) + 1) * total // weights[s]), s))
        s = heappop(ready)[1]
        slots[s].append(t)
        if len(slots[s]) < weights[s]:
            heappush(later, (len(slots[s]) * total // weights[s], s))
    return slots


def size_weights(docs: DataFrame, source_col: str, total: int, exponent: float) -> list[tuple]:
    """(source, rows, weight) of every source; weights follow rows ** exponent and add up to ``total``, or to
    PER_SOURCE a source where that is more."""
    sizes = docs.groupBy(F.col(source_col).alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()
    sizes = sorted(((r["s"], r["n"]) for r in sizes), key=lambda x: (x[0] is None, x[0]))
    weights = quantise([n ** exponent for _, n in sizes], max(total, PER_SOURCE * len(sizes))) if sizes else []
    return [(s, n, w) for (s, n), w in zip(sizes, weights)]


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", targets: dict | None = None, total: int = 1000,
        exponent: float = 0.5, block: int = 16, bucket_rows: int = 4096, seed: int = 7) -> DataFrame:
    """``docs`` with mix_weight (of ``total``), mix_block, mix_release, mix_deadline, mix_slot, mix_pos (place in the stream)
    and on_target, which replace columns of these names.  ``targets`` (source to weight) replaces weights by size; all sources must then have one."""
    kept = [c for c in docs.columns if c not in ADDED or c in (id_col, source_col)]
    names = {c: f"c{i}" for i, c in enumerate(kept)}  # inside, columns of the documents cannot clash with others
    docs, id_col, source_col = docs.select(*[F.col(c).alias(n) for c, n in names.items()]), names[id_col], names[source_col]
    sources = size_weights(docs, source_col, total, exponent)
    total = sum(w for _, _, w in sources)
    if targets is not None and sources:
        weights = quantise([targets[s] for s, _, _ in sources], total)
        sources = [(s, n, w) for (s, n, _), w in zip(sources, weights)]
    spark, kind = docs.sparkSession, dict(docs.dtypes)[source_col]
    slots = period([w for _, _, w in sources])
    ends = [(n // block // w) * total + slots[i][n // block % w] for i, (_, n, w) in enumerate(sources)]
    horizon = min(ends, default=0)  # the first slot that some source cannot fill
    # one row per source and, together, `total` slots
    table = spark.createDataFrame([(i, s, w, slots[i]) for i, (s, _, w) in enumerate(sources)],
                                  f"__s int, __source {kind}, mix_weight long, __slots array<int>")
    bits = max(0, math.ceil(math.log2(max(1, sum(n for _, n, _ in sources)) / bucket_rows))) if sources else 0
    h = F.xxhash64(F.col(id_col), F.lit(seed))
    bucket = F.shiftrightunsigned(h, 64 - bits) if bits else F.lit(0).cast("long")
    known = F.broadcast(table) if total <= BROADCAST_SLOTS else table
    keyed = (docs.join(known.drop("__slots"), F.col(source_col).eqNullSafe(F.col("__source")))
             .drop("__source").withColumn("__h", h).withColumn("__b", bucket))
    before = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (keyed.groupBy("__s", "__b").agg(F.count(F.lit(1)).alias("__n"))
               .select("__s", "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset")))
    inside = Window.partitionBy("__s", "__b").orderBy("__h", id_col)
    ranked = (keyed.withColumn("__r", F.row_number().over(inside) - 1).join(offsets, ["__s", "__b"])
              .withColumn("__r", F.col("__r") + F.col("__offset")))
    j, w = F.col("mix_block"), F.col("mix_weight")
    out = (ranked.withColumn("mix_block", F.expr(f"__r div {block}"))
           .join(known.select(F.col("__s").alias("__t"), "__slots"), F.col("__s") == F.col("__t"))
           .withColumn("mix_release", F.expr(f"mix_block * {total} div mix_weight"))
           .withColumn("mix_deadline", F.expr(f"((mix_block + 1) * {total} + mix_weight - 1) div mix_weight"))
           .withColumn("mix_slot", F.expr("mix_block div mix_weight") * total + F.get("__slots", (j % w).cast("int")))
           .withColumn("mix_pos", F.col("mix_slot") * block + F.col("__r") % block)
           .withColumn("on_target", F.col("mix_slot") < horizon))
    return out.select(*[F.col(n).alias(c) for c, n in names.items()], *ADDED)
