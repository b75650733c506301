"""List utilities on long tables (H1-H5).

A list is the set of rows sharing ``list_id``; positions are explicit
columns, never array indices, so every utility is a scan, a join or an
aggregate and a long list is spread over tasks by ``ordered_scan``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scan import ordered_scan, written
from tessera.functions.stable import stable_u01
from tessera.operators.topn import first_rows


def sort_by_scores(df: DataFrame, n: int | None = None, shuffle_ties: bool = False,
                   seed: int = 42, method: str = "auto") -> DataFrame:
    """H1: rows by score descending, top ``n`` kept, ``pos`` 1-based.

    Ties are broken by ``item_id``, or by a seeded stable uniform of
    ``item_id`` when ``shuffle_ties`` (reproducible under retries).
    """
    tie = stable_u01("item_id", seed) if shuffle_ties else F.lit(0.0)
    x = df.withColumn("__tie", tie)
    return first_rows(x, ["list_id"], [F.col("score").desc(), F.col("__tie").asc(), F.col("item_id").asc()], n,
                      method=method).drop("__tie")


def sorted_ranks(df: DataFrame, method: str = "auto") -> DataFrame:
    """H2: 1-based rank of each row's score in its list, rows in input order.

    Example: scores [1.0, 3.5, 2.1] -> ranks [3, 1, 2].
    """
    return sort_by_scores(df, None, method=method).withColumnRenamed("pos", "rank")


def organize_valid(df: DataFrame, valid: str = "valid", shuffle: bool = False,
                   seed: int = 42, position: str = "position",
                   method: str = "auto") -> DataFrame:
    """H3: valid rows first, then the rest; inside each part shuffled (stable
    uniform per item and seed) or in original ``position`` order.  Adds
    0-based ``new_pos``."""
    inner = stable_u01("item_id", seed) if shuffle else F.col(position).cast("double")
    x = df.withColumn("__inv", F.when(F.col(valid), 0).otherwise(1)).withColumn("__k", inner)
    r = ordered_scan(x, ["list_id"], [F.col("__inv").asc(), F.col("__k").asc(),
                                      F.col("item_id").asc()], pos="__p", method=method)
    return r.select(*df.columns, (F.col("__p") - 1).alias("new_pos"))


def pad_circular(df: DataFrame, size: int, valid: str = "valid",
                 position: str = "position", method: str = "auto") -> DataFrame:
    """H4: lists padded (or cut) to ``size`` by repeating valid rows circularly.

    Output row ``p`` (0..size-1) of a list takes its valid row number
    ``p mod n_valid`` (``n_valid = 0`` treated as 1) and ``mask = p < n_valid``.
    Example: size 3, two valid rows -> sources [0, 1, 0], mask [T, T, F].
    """
    org = organize_valid(df, valid, False, position=position, method=method)
    lists = df.groupBy("list_id").agg(
        F.sum(F.when(F.col(valid), 1).otherwise(0)).alias("__nv"))
    slots = lists.select("list_id", "__nv",
                         F.explode(F.sequence(F.lit(0), F.lit(size - 1))).alias("slot"))
    slots = slots.withColumn("new_pos", F.pmod(F.col("slot"), F.greatest(F.col("__nv"), F.lit(1))))
    out = slots.join(org, ["list_id", "new_pos"])
    return out.select("list_id", "slot", *[c for c in df.columns if c != "list_id"],
                      (F.col("slot") < F.col("__nv")).alias("mask"))


def de_noise(counts: DataFrame, noise: DataFrame | None, ratio: float = 0.9,
             method: str = "auto", hot: DataFrame | None | str = "find") -> DataFrame:
    """H5: exact ML estimate of the true distribution behind noisy counts.

    ``counts(list_id, key, count >= 0)`` and ``noise(list_id, key, noise > 0)``
    (None when ``counts`` has the column already) model ``ratio * noise + (1 - ratio) * true``.  Per list, noise is
    normalised to a simplex, keys are ordered by ``count / noise`` descending
    (ties by key), and key ``i`` stays positive when
    ``(odds + cum_noise_i) / cum_count_i > noise_i / count_i`` with
    ``odds = (1 - ratio) / ratio``.  With
    ``lambda = sum_kept(count) / (1 + sum_kept(noise) / odds)`` the result is
    ``count / lambda - noise / odds`` on kept keys and 0 elsewhere; each list
    sums to 1.  Every (list, key) of ``counts`` is in the result: a list whose
    counts are all zero has value 0 everywhere, a key without noise is an error.

    ``hot``: lists that the scan must split, as in ``ordered_scan``.  When the caller knows that there are none, totals, scan and
    lambda are windows over the same lists: the rows move once, and none is written.
    """
    if not 0 < ratio < 1:
        raise ValueError(f"ratio should be in (0, 1), got {ratio}")
    odds = (1 - ratio) / ratio
    j = counts if noise is None else counts.join(noise, ["list_id", "key"], "left")
    # checked lazily inside the plan: a violating row fails the job
    ok = F.assert_true((F.col("count") >= 0) & F.coalesce(F.col("noise") > 0, F.lit(False)), "counts must be >= 0 and noise > 0")
    j = j.filter(F.coalesce(ok.cast("boolean"), F.lit(True)))
    order = [(F.col("c") / F.col("n")).desc(), F.col("key").asc()]
    # (odds + cum_n) / cum_c > n / c, cross-multiplied (both denominators > 0
    # when c > 0; a zero count is never kept)
    keep = (F.col("c") > 0) & ((F.lit(odds) + F.col("cum_n")) * F.col("c") > F.col("n") * F.col("cum_c"))
    lam = (F.sum(F.when(F.col("is_pos"), F.col("c")).otherwise(0.0)), F.sum(F.when(F.col("is_pos"), F.col("n")).otherwise(0.0)))
    val = F.when(F.col("is_pos"), F.col("c") / F.col("__lam") - F.col("n") / odds).otherwise(0.0)
    if hot is None and method == "auto":
        # a list's total joins nothing: rows without a list are dropped here, by a filter that stays above the aggregate of
        # counts (they are >= 0), so that other readers of its input can share the exchange
        whole = Window.partitionBy("list_id")
        x = j.filter(F.col("list_id").isNotNull() | (F.col("count") < 0)).select(
            "list_id", "key", F.col("count").cast("double").alias("c"), (F.col("noise") / F.sum("noise").over(whole)).alias("n"))
        s = ordered_scan(x, ["list_id"], order, ["n", "c"], method="window").withColumn("is_pos", keep)
        s = s.withColumn("__lam", lam[0].over(whole) / (1.0 + lam[1].over(whole) / odds))
        return s.select("list_id", "key", val.alias("value"))
    tot = j.groupBy("list_id").agg(F.sum("noise").alias("__ns"))
    x = (j.join(tot, "list_id")
         .select("list_id", "key", F.col("count").cast("double").alias("c"),
                 (F.col("noise") / F.col("__ns")).alias("n")))
    s = ordered_scan(written(x), ["list_id"], order, ["n", "c"], method=method, hot=hot).withColumn("is_pos", keep)
    out = s.join(s.groupBy("list_id").agg((lam[0] / (1.0 + lam[1] / odds)).alias("__lam")), "list_id")
    return out.select("list_id", "key", val.alias("value"))
