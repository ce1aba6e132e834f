"""Places and running sums over a total order, without a window that one task
works off: rows are range-partitioned and written once, each range adds up
its own rows, and the ranges' totals (one row per range) give the offsets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.session import materialize

ROWS_PER_RANGE = 100_000


def running_sums(df: DataFrame, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with a running sum of each column expression of ``sums``, in
    the order given, the row itself included.

    The order must tell all rows apart, or equal ones get their sums in any
    order.  Nulls come where ``order`` says.  ``df`` is read once, if it is a
    staged table: ranges are cut by a sample of it, then it is dealt out.
    """
    ranges = max(1, math.ceil(df.count() / ROWS_PER_RANGE))
    names = list(sums)
    rows = df.select("*", *(sums[n].alias(n) for n in names))
    rows = materialize(rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)      # one row per range
    offsets = rows.groupBy("_range").agg(*(F.sum(n).alias(f"_t{i}") for i, n in enumerate(names)))
    offsets = offsets.select("_range", *(F.coalesce(F.sum(f"_t{i}").over(before), F.lit(0)).alias(f"_o{i}")
                                         for i in range(len(names))))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = rows.select(*df.columns, "_range", *(F.sum(n).over(within).alias(n) for n in names)).join(offsets, "_range")
    return out.select(*df.columns, *((F.col(n) + F.col(f"_o{i}")).alias(n) for i, n in enumerate(names)))


def with_place(df: DataFrame, *order: str, out: str = "place") -> DataFrame:
    """``df`` with each row's place from 1 on in the order of the columns."""
    return running_sums(df, [F.asc_nulls_first(c) for c in order], {out: F.lit(1).cast("bigint")})
