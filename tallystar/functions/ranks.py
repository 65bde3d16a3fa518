"""Running totals and ranks without a window over the whole table.

A window without PARTITION BY (or one with a hot key) sorts all its rows in
one task. Here rows are dealt by ranges of (keys, order), each range sums its
own rows, and every range adds the total of the ranges before it: the only
window that crosses ranges sees one row for each (key, range).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.session import cut_lineage


def running_total(df: DataFrame, keys: Sequence[str], order: str, value: str, column: str) -> DataFrame:
    """``df`` with ``column``: the sum of ``value`` over the rows of the same
    keys up to this row in rising ``order`` (one row for each key and order)."""
    keys = list(keys)
    # The range number is written with the rows: reading it again cannot change it.
    ranged = cut_lineage(df.repartitionByRange(*keys, order).withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy(*keys, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    across = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = (ranged.groupBy(*keys, "_range").agg(F.sum(value).alias("_sum"))
              .withColumn("_before", F.coalesce(F.sum("_sum").over(across), F.lit(0))).drop("_sum"))
    return (ranged.withColumn(column, F.sum(value).over(inside)).join(before, [*keys, "_range"])
            .withColumn(column, F.col(column) + F.col("_before")).drop("_range", "_before"))
