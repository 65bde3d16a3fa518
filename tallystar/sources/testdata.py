"""Bind the supplied TPC-H-style tables to the sales star schema.

The supplied tables (``part``, ``orders``, ``lineitem``) stand in for the raw
order files. The mapping is fixed so that Spark and the DuckDB oracle build
byte-identical star tables:

* product  = ``p_brand``; product name = ``'The ' || brand``;
  category = ``'cat_' || (brand number mod 4)``
* size     = ``p_size`` bucketed into S/M/L/XL/XXL
* SKU      = product x size; list price = cheapest part of that SKU times a
  size multiplier
* order line = ``lineitem`` row; order date from ``orders``; time of day a
  deterministic function of the order key (09:00 - 22:59)

Every frame here is lazy, but for a count of the lines (of their files' footers)
that sets the partitions of the joins. Nothing is collected; Catalyst prunes
columns and pushes filters into the parquet scans of whichever star table a
query uses.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.scalar import (day_name, iso_weekday, meal_period,
                                        month_name)
from tallystar.session import ROWS_PER_TASK, deal_count, dealt

# Fixed binding constants (the DuckDB oracle text in plans/oracle_sql.py states the same).
SIZE_UPPER = [(10, "S"), (20, "M"), (30, "L"), (40, "XL")]   # p_size <= bound
SIZE_MULTIPLIER = {"S": "0.80", "M": "1.00", "L": "1.25", "XL": "1.60", "XXL": "2.20"}
OPEN_SECONDS = 32400          # 09:00:00
OPEN_SPAN_SECONDS = 50400     # 14 hours
TIME_HASH_MULTIPLIER = 7919


def _size(p_size) -> F.Column:
    expr = None
    for bound, label in SIZE_UPPER:
        expr = (F.when(p_size <= bound, label) if expr is None
                else expr.when(p_size <= bound, label))
    return expr.otherwise("XXL")


def _multiplier(size) -> F.Column:
    expr = None
    for label, m in SIZE_MULTIPLIER.items():
        lit = F.lit(Decimal(m)).cast("decimal(4,2)")
        expr = F.when(size == label, lit) if expr is None else expr.when(size == label, lit)
    return expr


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def part_sizes(part: DataFrame) -> DataFrame:
    return part.select(F.col("p_partkey"), F.col("p_brand").alias("product_id"),
                       _size(F.col("p_size")).alias("size"), F.col("p_retailprice"))


def dim_sku(part: DataFrame) -> DataFrame:
    """SKU = product x size. Grouped output is bounded by brands x 5 sizes."""
    base = (part_sizes(part)
            .groupBy("product_id", "size")
            .agg(F.min(F.col("p_retailprice").cast("decimal(8,2)")).alias("base_price")))
    return base.select(
        F.concat(F.col("product_id"), F.lit("_"), F.col("size")).alias("sku_id"),
        "product_id", "size",
        (F.col("base_price") * _multiplier(F.col("size"))).cast("decimal(8,2)").alias("price"))


def dim_product(part: DataFrame) -> DataFrame:
    brands = part.select(F.col("p_brand").alias("product_id")).distinct()
    return brands.select(
        "product_id",
        F.concat(F.lit("The "), F.col("product_id")).alias("name"),
        F.concat(F.lit("cat_"),
                 (F.substring("product_id", 7, 100).cast("int") % 4).cast("string")).alias("category"))


def time_of_order(order_key) -> F.Column:
    """Seconds of day of an order; NULL for an unknown order."""
    return (F.lit(OPEN_SECONDS) + (order_key * TIME_HASH_MULTIPLIER) % OPEN_SPAN_SECONDS).cast("int")


def order_times(orders: DataFrame) -> DataFrame:
    """Distinct times of day of the order headers (orders without lines too)."""
    return orders.select(time_of_order(F.col("o_orderkey")).alias("time_id")).distinct()


def fact_sales(lineitem: DataFrame, orders: DataFrame, part: DataFrame,
               sku: DataFrame | None = None) -> DataFrame:
    """One row per order line.

    Plan shape: lineitem joins orders on the order key (sort-merge on both
    big sides) and joins the part -> SKU map on the part key (large catalogues
    by sort-merge as well). Tables of more lines than ``deal_count`` leaves to
    the session are dealt for these joins in partitions of a set number of
    lines, so no sort grows with the table; smaller ones are left to AQE,
    which splits a hot key. Both are LEFT joins, so lines of unknown orders or parts stay (with
    NULL date, time and SKU) and the audits can see them. The SKU table (product
    x size) carries no hint: it is broadcast when Spark's size check says it is
    small, as it is for any menu-sized catalogue.
    """
    sku = sku if sku is not None else dim_sku(part)
    part_sku = (part_sizes(part).drop("p_retailprice")
                .join(sku, ["product_id", "size"])
                .select("p_partkey", "sku_id", "product_id", "price"))
    li = lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    # Both sides grow with the orders: never a broadcast, however few bytes the
    # files of the two columns are estimated at (9 million orders: 800 MB a task).
    od = orders.select(F.col("o_orderkey"), F.col("o_orderdate").cast("date").alias("date_id"))
    n = deal_count(li)
    li, od = dealt(li, n, "l_orderkey"), dealt(od, n, "o_orderkey").hint("merge")
    qty = F.col("l_quantity").cast("int")
    lines = li.join(od, li.l_orderkey == od.o_orderkey, "left")
    if n is not None and part.count() > ROWS_PER_TASK:
        lines, part_sku = dealt(lines, n, "l_partkey"), dealt(part_sku, n, "p_partkey").hint("merge")
    return (lines.join(part_sku, F.col("l_partkey") == part_sku.p_partkey, "left")
            .select(F.col("l_orderkey").alias("order_id"),
                    F.col("l_linenumber").alias("line_no"),
                    F.col("date_id"),
                    time_of_order(F.col("o_orderkey")).alias("time_id"),
                    "sku_id", "product_id",
                    qty.alias("quantity"),
                    F.col("price").alias("unit_price"),
                    (qty * F.col("price")).cast("decimal(12,2)").alias("total_price")))


def dim_time_from_ids(time_ids: DataFrame) -> DataFrame:
    """Seconds-of-day ids -> hour, minute, meal period (TIME type is off in Spark 4.1)."""
    t = F.col("time_id")
    hour = F.floor(t / 3600).cast("int")
    return time_ids.select(
        t.alias("time_id"), hour.alias("hour"),
        F.floor((t % 3600) / 60).cast("int").alias("minute"),
        meal_period(hour).alias("meal_period"))


def dim_date_from_dates(dates: DataFrame) -> DataFrame:
    d = F.col("date_id")
    dow = iso_weekday(d)
    return dates.select(
        d.alias("date_id"),
        F.year(d).alias("year"), F.quarter(d).alias("quarter"), F.month(d).alias("month"),
        month_name(d).alias("month_name"), F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day_of_month"), dow.alias("day_of_week"),
        day_name(d).alias("day_name"),
        F.when(dow >= 6, 1).otherwise(0).cast("int").alias("is_weekend"))


@dataclass
class Star:
    """The five star-schema tables as lazy DataFrames."""
    fact: DataFrame
    dim_sku: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    dim_time: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"fact_sales": self.fact, "dim_sku": self.dim_sku,
                "dim_product": self.dim_product, "dim_date": self.dim_date,
                "dim_time": self.dim_time}


def star_from_tables(lineitem: DataFrame, orders: DataFrame, part: DataFrame) -> Star:
    sku = dim_sku(part)
    fact = fact_sales(lineitem, orders, part, sku)
    dates = orders.select(F.col("o_orderdate").cast("date").alias("date_id")).distinct()
    return Star(fact=fact, dim_sku=sku, dim_product=dim_product(part),
                dim_date=dim_date_from_dates(dates),
                dim_time=dim_time_from_ids(order_times(orders)))


def star_from_dir(spark: SparkSession, sf_dir: str) -> Star:
    """Star schema over ``{sf_dir}/{lineitem,orders,part}.parquet``.

    If a materialised copy was registered for this folder (see
    ``plans.warehouse_job``), its parquet tables are used instead, which
    saves re-running the lineitem/orders join for every query.
    """
    from tallystar.plans import warehouse_job

    built = warehouse_job.lookup(spark, sf_dir)
    if built is not None:
        return built
    return star_from_tables(read_table(spark, sf_dir, "lineitem"),
                            read_table(spark, sf_dir, "orders"),
                            read_table(spark, sf_dir, "part"))
