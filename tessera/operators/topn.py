"""Top-N per group.

``rank()`` keeps ties, so a group may return more than ``n`` rows, which is
the reference's behaviour; ``ties='row_number'`` returns exactly ``n`` rows
per group and needs a tie-break for determinism.  A ``rank``/``row_number``
filter over a partitioned window lets Catalyst insert a partial
WindowGroupLimit before the shuffle, so at most ``n`` (plus ties) rows per
group and map task cross the network even for a hot group.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.scan import ordered_scan


def _cols(xs):
    if xs is None:
        return []
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def top_n(df: DataFrame, by, order: Sequence[Column] | Column, n: int,
          ties: str = "rank", tie_break=None, rank_col: str | None = None) -> DataFrame:
    """Keep the first ``n`` rows per ``by`` group under ``order``.

    ``ties='rank'`` keeps every row tied with the n-th; ``'row_number'``
    breaks ties by ``tie_break`` columns (ascending).
    """
    if n < 1:
        raise ValueError("n must be >= 1")
    order = _cols(order)
    if ties == "row_number":
        order = order + [c.asc() for c in _cols(tie_break)]
    w = Window.partitionBy(*_cols(by)).orderBy(*order)
    if ties == "rank":
        r = F.rank().over(w)
    elif ties == "row_number":
        r = F.row_number().over(w)
    elif ties == "dense_rank":
        r = F.dense_rank().over(w)
    else:
        raise ValueError(f"unknown ties mode {ties!r}")
    name = rank_col or "__rank"
    out = df.withColumn(name, r).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int | None,
               sums: Sequence[str] = (), pos: str = "pos", method: str = "auto", **kw) -> DataFrame:
    """``ordered_scan`` of the first ``n`` rows per group (all when None).

    With ``n`` the rows are cut by a row_number filter, which is pruned
    map-side; the running sums then see at most ``n`` rows per group.
    """
    if n is None:
        return ordered_scan(df, keys, order, sums, pos=pos, method=method, **kw)
    top = top_n(df, list(keys), order, n, ties="row_number", rank_col=pos)
    upto = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return top.select(*df.columns, F.col(pos).cast("long").alias(pos),
                      *[F.sum(F.col(c).cast("double")).over(upto).alias("cum_" + c) for c in sums])


# Scores are ranked on 34 significant bits (about 10 digits at any magnitude)
# so that floating-point noise from summation order cannot split
# mathematically equal scores.  x * c - (x * c - x) with c = 2**19 + 1 rounds
# to them in plain double arithmetic, the same in Spark, numpy and SQL.
TIE_SPLIT = 524289.0


def tie_key(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    c = c.cast("double")
    scaled = c * F.lit(TIE_SPLIT)
    return scaled - (scaled - c)


def sql_tie_key(expr: str) -> str:
    x, scaled = f"cast({expr} AS double)", f"cast({expr} AS double) * cast(524289 AS double)"
    return f"({scaled} - ({scaled} - {x}))"
