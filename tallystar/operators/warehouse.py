"""Warehouse build from the raw order files.

Each builder is a projection or a ``distinct`` plus native date/time
functions; the fact is the order lines LEFT JOIN order headers LEFT JOIN
the price list. The price list is one row per SKU, so it is broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.operators.audit import row_counts as _row_counts
from tallystar.sources.testdata import dim_date_from_dates, dim_time_from_ids


def build_dim_product(raw_products: DataFrame) -> DataFrame:
    return raw_products.select(F.col("pizza_type_id").alias("product_id"), "name", "category",
                               "ingredients")


def build_dim_sku(raw_skus: DataFrame) -> DataFrame:
    return raw_skus.select(F.col("pizza_id").alias("sku_id"),
                           F.col("pizza_type_id").alias("product_id"), "size", "price")


def build_dim_date(orders: DataFrame) -> DataFrame:
    """Only dates that occur in the order headers (not a full calendar)."""
    return dim_date_from_dates(orders.select("date_id").where(F.col("date_id").isNotNull())
                               .distinct())


def build_dim_time(orders: DataFrame) -> DataFrame:
    return dim_time_from_ids(orders.select("time_id").where(F.col("time_id").isNotNull())
                             .distinct())


def build_fact(lines: DataFrame, orders: DataFrame, dim_sku: DataFrame) -> DataFrame:
    """Order lines with date, time, product and prices.

    ``lines`` x ``orders`` is a big-to-big join on order_id (shuffled; AQE
    splits skewed keys). The SKU side is one row per SKU, so it is broadcast.
    """
    sku = dim_sku.select("sku_id", "product_id", F.col("price").alias("unit_price"))
    qty = F.col("quantity")
    return (lines.join(orders, "order_id", "left")
            .join(F.broadcast(sku), lines.pizza_id == sku.sku_id, "left")
            .select(F.col("order_details_id").alias("line_id"), "order_id", "date_id", "time_id",
                    F.col("pizza_id").alias("sku_id"), "product_id", qty.alias("quantity"),
                    "unit_price", (qty * F.col("unit_price")).cast("decimal(8,2)").alias("total_price")))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _row_counts(tables)
