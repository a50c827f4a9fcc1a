"""Running totals over all rows in an order, without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.session import materialise


def running(rows: DataFrame, order: list[str], value: Column, name: str, label: str) -> DataFrame:
    """
    Add `name`, the sum of `value` over all rows before a row in the order of `order`.

    Rows are dealt by ranges of the order and stored. What is added are sums in a range, and
    the totals of earlier ranges, one number for each. Rows that are equal in `order` come in
    any order, but must not differ in what matters to the caller.
    """
    ranged = materialise(rows.repartitionByRange(*order).withColumn("_range",
                                                                    F.spark_partition_id()), label)
    within = Window.partitionBy("_range").orderBy(*order) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range").agg(F.sum(value).alias("_total"))
    base = totals.select("_range", F.coalesce(F.sum("_total").over(before), F.lit(0))
                         .alias("_base"))
    # One row for each range, whose number is that of the shuffle's partitions at most.
    return ranged.withColumn(name, F.sum(value).over(within) - value) \
        .join(F.broadcast(base), "_range") \
        .withColumn(name, (F.col(name) + F.col("_base")).cast("long")).drop("_range", "_base")
