"""Order composition: how many distinct products an order holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.scalar import ORDER_TYPE_ORDER, exact_round, level_position


LINES = 1_000_000            # order lines in one partition of the distinct step


def order_products(fact: DataFrame) -> DataFrame:
    """Distinct (order, product) rows.

    Nearly all of them differ, so a distinct in the scan tasks would hold a
    whole file split in its hash table. The lines are dealt by both columns
    first, in partitions of about ``LINES``, and made distinct there; the lines
    of an order of any size are spread over its products.
    """
    lines = fact.select("order_id", "product_id")
    least = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartition(max(least, -(-lines.count() // LINES)), "order_id", "product_id").distinct()


def order_sizes(fact: DataFrame) -> DataFrame:
    """Distinct products per order, counted from the distinct (order, product) rows."""
    return order_products(fact).groupBy("order_id").agg(F.count("product_id").alias("total_items"))


def _with_share(df: DataFrame) -> DataFrame:
    """Share of all orders. Every order is one row of ``order_sizes`` (order_id
    is NOT NULL in the fact), so the total is the sum of the buckets: a window
    over a handful of rows instead of a second distinct count over the fact."""
    df = df.withColumn("_total", F.sum("order_count").over(Window.partitionBy()))
    return (df.withColumn("share_pct", exact_round(F.col("order_count") * 100, "_total", 1))
            .drop("_total"))


def order_size_distribution(fact: DataFrame) -> DataFrame:
    df = (order_sizes(fact).groupBy("total_items")
          .agg(F.count(F.lit(1)).alias("order_count"))
          .withColumn("total_items", F.col("total_items").cast("long")))
    return _with_share(df).orderBy("total_items")


def order_type(total_items) -> F.Column:
    return (F.when(total_items == 1, ORDER_TYPE_ORDER[0])
            .when(total_items.between(2, 4), ORDER_TYPE_ORDER[1])
            .when(total_items >= 5, ORDER_TYPE_ORDER[2]))


def order_type_split(fact: DataFrame) -> DataFrame:
    df = (order_sizes(fact).select(order_type(F.col("total_items")).alias("order_type"))
          .groupBy("order_type").agg(F.count(F.lit(1)).alias("order_count")))
    return _with_share(df).orderBy(level_position("order_type", ORDER_TYPE_ORDER))
