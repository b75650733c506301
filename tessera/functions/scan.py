"""Ordered scans inside groups that stay balanced when one group is huge.

``ordered_scan(df, keys, order, sums)`` adds, for every row, its 1-based
position inside its ``keys`` group under ``order`` and inclusive running
sums of ``sums`` -- what ``row_number()`` and ``sum() over (rows unbounded
preceding)`` give, but without sending a huge group to one task.

``method='auto'`` (default) counts the groups first, an aggregate with
map-side combine over the key columns alone.  Groups of at most ``hot_rows``
rows go through plain window functions: one hash exchange on the keys, which
later joins and aggregates on the same keys reuse, no Python and nothing
written.  Larger groups, at most rows / ``hot_rows`` of them, are looked up
in a table of their keys and go through the range scan; the results are put
together.  A group is never cut by size without the offsets that make it whole.

``method='range'`` is the range scan for all rows:

1. ``repartitionByRange(n, keys..., order...)`` cuts the globally sorted rows
   into ``n`` ranges; a hot group simply spans several ranges;
2. one pass per range (``mapInArrow``) appends the range's number, positions
   and sums local to the range, and a mark on the range's last row.  The rows
   themselves stay Arrow columns: no value is converted;
3. the result is written once to the shared checkpoint folder, so positions
   and offsets come from one and the same assignment of rows to ranges,
   whatever is re-planned, reused or recomputed later;
4. only a range's last group can go on in the next range: the marked rows, one
   per range, give the offsets, the only thing that is broadcast.

The number of ranges follows the optimizer's size estimate (at least the
default parallelism, at most ``spark.sql.shuffle.partitions``).  Without keys
all rows are one group, and the range scan is what runs.

``method='window'`` is plain window functions for callers that know their
groups are small.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Sequence
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import ensure_checkpoint_dir, ship_package


HOT_ROWS = 200_000


def _to_cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _differs(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Null-safe ``a != b``; NaN equals NaN."""
    ne = pc.fill_null(pc.not_equal(a, b), False).to_numpy(zero_copy_only=False)
    if pa.types.is_floating(a.type):
        both = pc.and_(pc.fill_null(pc.is_nan(a), False), pc.fill_null(pc.is_nan(b), False))
        ne = ne & ~both.to_numpy(zero_copy_only=False)
    return ne | (pc.is_null(a).to_numpy(zero_copy_only=False) != pc.is_null(b).to_numpy(zero_copy_only=False))


def _scan_partition(keys: list[str], sums: list[str]):
    def fn(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        last = None  # keys of the previous batch's last row, one-element arrays
        carry_pos, carry = 0, {c: 0.0 for c in sums}
        held = None  # the last batch seen: its last row may be the range's last

        def emit(batch, pos, totals, final):
            mark = np.zeros(len(pos), dtype=bool)
            mark[-1] = final
            extra = [pa.array(np.full(len(pos), pid, dtype=np.int32)), pa.array(pos), pa.array(mark),
                     *[pa.array(totals[c]) for c in sums]]
            names = ["__pid", "__lpos", "__last", *[f"__lsum_{c}" for c in sums]]
            return pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *names])

        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            key = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            changed = np.zeros(n, dtype=bool)
            for a in key:
                changed[1:] |= _differs(a.slice(1), a.slice(0, n - 1))
            cont = last is not None and not any(_differs(a.slice(0, 1), b)[0] for a, b in zip(key, last))
            changed[0] = True
            start = np.maximum.accumulate(np.where(changed, np.arange(n), 0))
            first = start == 0
            pos = (np.arange(n) - start + 1).astype(np.int64) + np.where(first & cont, carry_pos, 0)
            totals = {}
            for c in sums:
                col = pc.cast(batch.column(batch.schema.get_field_index(c)), pa.float64())
                v = pd.Series(pc.fill_null(col, 0.0).to_numpy(zero_copy_only=False))
                totals[c] = v.groupby(start, sort=False).cumsum().to_numpy() + np.where(first & cont, carry[c], 0.0)
                carry[c] = float(totals[c][-1])
            carry_pos, last = int(pos[-1]), [a.slice(n - 1, 1) for a in key]
            if held is not None:
                yield emit(*held, False)
            held = (batch, pos, totals)
        if held is not None:
            yield emit(*held, True)
    return fn


def _range_count(df: DataFrame) -> int:
    """Number of ranges: the optimizer's size estimate over the advisory
    partition size, at least the default parallelism, capped by
    ``spark.sql.shuffle.partitions``.

    The ranges are fixed (AQE does not coalesce an explicit range
    repartition), so small inputs should not be cut into hundreds of tiny
    Python tasks; size estimates err on the large side, so big inputs get
    the full shuffle parallelism.
    """
    spark = df.sparkSession
    cap = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    try:
        target_b = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(target))
        est = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # estimates unavailable: use the configured parallelism
        return cap
    floor = min(cap, spark.sparkContext.defaultParallelism)  # keep every core busy
    return max(1, floor, min(cap, -(-est // max(target_b, 1))))


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: for narrow tables that are costly to
    compute and read more than once."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/scan-input-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_groups(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys (``__h0``, ``__h1``, ...) of the groups with more than ``hot_rows`` rows; None when there is none.

    The table is written once, so both halves of a scan see the same groups, and left to the optimizer to join: it
    holds at most rows / ``hot_rows`` rows.
    """
    return hot_sums(df, keys, None, hot_rows)


def hot_sums(df: DataFrame, keys: Sequence[str], size: str | None, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """``hot_groups`` of a table whose rows stand for ``size`` rows each."""
    names = [f"__h{i}" for i in range(len(keys))]
    rows = F.count(F.lit(1)) if size is None else F.sum(size)
    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(rows.alias("__n"))
    hot = counts.filter(F.col("__n") > hot_rows).select(*names)
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/scan-hot-{uuid4().hex}"
    hot.write.parquet(path)
    hot = df.sparkSession.read.schema(hot.schema).parquet(path)
    return None if hot.isEmpty() else hot


def ordered_scan(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                 sums: Sequence[str] = (), pos: str = "pos", prefix: str = "cum_",
                 method: str = "auto", num_partitions: int | None = None,
                 hot_rows: int = HOT_ROWS, hot: DataFrame | None | str = "find") -> DataFrame:
    """Add ``pos`` (1-based) and ``cum_<c>`` running sums within ``keys``.

    ``hot``: what ``hot_groups`` found for the first keys of a table that has at least these rows in every group, so
    that several scans of the same groups look for them once.

    ``order`` must make rows unique within a group for a deterministic
    result (add a tie-break column).
    """
    keys, sums = list(keys), list(sums)
    order = _to_cols(order)
    if method == "auto":
        if not keys:
            return ordered_scan(df, keys, order, sums, pos, prefix, "range", num_partitions)
        if isinstance(hot, str):
            hot = hot_groups(df, keys, hot_rows)
        if hot is None:
            return ordered_scan(df, keys, order, sums, pos, prefix, "window")
        same = reduce(and_, [F.col(k).eqNullSafe(F.col(h)) for k, h in zip(keys, hot.columns)])
        small = ordered_scan(df.join(hot, same, "left_anti"), keys, order, sums, pos, prefix, "window")
        large = ordered_scan(df.join(hot, same, "left_semi"), keys, order, sums, pos, prefix, "range", num_partitions)
        return small.unionByName(large)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        wr = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.select("*", F.row_number().over(w).alias(pos),
                         *[F.sum(F.col(c).cast("double")).over(wr).alias(prefix + c) for c in sums])
    if method != "range":
        raise ValueError(f"unknown method {method!r}")
    spark = df.sparkSession
    ship_package(spark)
    n = num_partitions or _range_count(df)
    key_cols = [F.col(k) for k in keys]
    ranged = df.repartitionByRange(n, *key_cols, *order).sortWithinPartitions(*key_cols, *order)
    schema = T.StructType(
        df.schema.fields
        + [T.StructField("__pid", T.IntegerType()), T.StructField("__lpos", T.LongType()),
           T.StructField("__last", T.BooleanType())]
        + [T.StructField(f"__lsum_{c}", T.DoubleType()) for c in sums])
    path = f"{ensure_checkpoint_dir(spark)}/scan-{uuid4().hex}"
    ranged.mapInArrow(_scan_partition(keys, sums), schema).write.parquet(path)
    local = spark.read.schema(schema).parquet(path)
    # one row per non-empty range: its last group, which is the only one that
    # the next range can continue, with the group's totals in all ranges so far
    same = Window.partitionBy(*keys).orderBy("__pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = ["__lpos", *[f"__lsum_{c}" for c in sums]]
    ends = local.filter("__last").select("__pid", *keys, *[F.sum(c).over(same).alias(f"__o{c}") for c in totals])
    follow = F.lead("__pid").over(Window.orderBy("__pid"))  # at most n rows
    o = (ends.withColumn("__next", follow).filter(F.col("__next").isNotNull())
         .select(F.col("__next"), *[F.col(c).alias(f"__k_{c}") for c in keys], *[f"__o{c}" for c in totals]))
    cond = F.col("__pid") == F.col("__next")
    for k in keys:  # null keys form a group like any other value
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    j = local.join(F.broadcast(o), cond, "left")
    out = [F.col(c) for c in df.columns]
    out.append((F.col("__lpos") + F.coalesce(F.col("__o__lpos"), F.lit(0))).alias(pos))
    out += [(F.col(f"__lsum_{c}") + F.coalesce(F.col(f"__o__lsum_{c}"), F.lit(0.0))).alias(prefix + c)
            for c in sums]
    return j.select(*out)
