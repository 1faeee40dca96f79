"""Whole-table ordered operations without a single-task sort.

The rows are range-partitioned on the order columns and the slice number is written down with them.
What crosses a slice border is then a table with one row per slice, which is as small as the number
of shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plugtide.functions.durable import durable


def sliced(df: DataFrame, order: list[str]) -> DataFrame:
    """`df` with a `_slice` number that never decreases along `order`.

    The table is written because the borders come from a sample: every later use must see the same
    ones. `order` should be (nearly) unique, so aggregate to distinct order values first.
    """
    ranged = df.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id())
    return durable(ranged, "sliced")


def running_totals(df: DataFrame, order: str, totals: dict[str, str], descending: bool) -> DataFrame:
    """Adds, per new name, the sum of a column over all rows up to and including this one."""
    rows = sliced(df, [order])
    direction = F.col(order).desc() if descending else F.col(order).asc()
    slice_order = F.col("_slice").desc() if descending else F.col("_slice").asc()

    within = Window.partitionBy("_slice").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy(slice_order).rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("_slice").agg(*[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()])
    offsets = slices.select(
        "_slice",
        *[F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in totals],
    )
    return (
        rows.join(F.broadcast(offsets), "_slice")
        .select(
            *df.columns,
            *[(F.sum(c).over(within) + F.col(f"_before_{n}")).alias(n) for n, c in totals.items()],
        )
    )


def previous_row(df: DataFrame, order: list[str], values: dict[str, str]) -> DataFrame:
    """Adds, per new name, a column of the row before this one in the whole table's order."""
    rows = sliced(df, order)
    within = Window.partitionBy("_slice").orderBy(*order)
    last = rows.groupBy("_slice").agg(
        F.max_by(F.struct(*values.values()), F.struct(*order)).alias("_last")
    )
    borders = last.select("_slice", F.lag("_last").over(Window.orderBy("_slice")).alias("_before"))
    return (
        rows.join(F.broadcast(borders), "_slice")
        .withColumn("_previous", F.coalesce(F.lag(F.struct(*values.values())).over(within), F.col("_before")))
        .select(*df.columns, *[F.col(f"_previous.{c}").alias(n) for n, c in values.items()])
    )
