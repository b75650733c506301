"""Dense global indexes without a single-partition window.

``global_index`` numbers the rows of a DataFrame 0..n-1 in a given order.  It
is an ``ordered_scan`` over one constant key: rows are range-partitioned on
the order, positioned inside their range, and offset by the sizes of the
earlier ranges (a table with one row per range).  No task ever holds more
than one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scan import ordered_scan


def global_index(df: DataFrame, order: list[Column | str], name: str = "idx",
                 num_partitions: int | None = None) -> DataFrame:
    x = df.withColumn("__all", F.lit(0))
    s = ordered_scan(x, ["__all"], order, pos="__gpos", method="range", num_partitions=num_partitions)
    return s.select(*df.columns, (F.col("__gpos") - 1).cast("bigint").alias(name))
