"""Registered queries for the star-schema build."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystar.functions.scalar import meal_period
from tallystar.operators import warehouse
from tallystar.plans.oracle_sql import with_star
from tallystar.plans.registry import query
from tallystar.sources.literal import calendar_of
from tallystar.sources.testdata import star_from_dir as star


@query("dim_product", "B", with_star("SELECT * FROM dim_product"))
def _dim_product(spark, sf):
    return star(spark, sf).dim_product


@query("dim_sku", "B", with_star("SELECT sku_id, product_id, size, CAST(price AS DOUBLE) AS price FROM dim_sku"))
def _dim_sku(spark, sf):
    return star(spark, sf).dim_sku.withColumn("price", F.col("price").cast("double"))


@query("dim_date", "B", with_star("SELECT * FROM dim_date"))
def _dim_date(spark, sf):
    return star(spark, sf).dim_date


@query("dim_time", "B", with_star("SELECT * FROM dim_time"))
def _dim_time(spark, sf):
    return star(spark, sf).dim_time


@query("meal_period", "B", with_star("""
SELECT DISTINCT hour, meal_period FROM dim_time"""))
def _meal_period(spark, sf):
    return (star(spark, sf).dim_time.select("hour").distinct()
            .select("hour", meal_period(F.col("hour")).alias("meal_period")).orderBy("hour"))


@query("fact_build", "B", with_star("""
SELECT order_id, line_no, date_id, time_id, sku_id, product_id, quantity,
       CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_price AS DOUBLE) AS total_price
FROM fact_sales"""))
def _fact_build(spark, sf):
    f = star(spark, sf).fact
    return f.select(*[F.col(c).cast("double") if c in ("unit_price", "total_price") else F.col(c)
                      for c in f.columns])


@query("row_counts", "B", with_star("""
SELECT 'fact_sales' AS table_name, COUNT(*) AS row_count FROM fact_sales
UNION ALL SELECT 'dim_sku', COUNT(*) FROM dim_sku
UNION ALL SELECT 'dim_product', COUNT(*) FROM dim_product
UNION ALL SELECT 'dim_date', COUNT(*) FROM dim_date
UNION ALL SELECT 'dim_time', COUNT(*) FROM dim_time"""))
def _row_counts(spark, sf):
    return warehouse.row_counts(star(spark, sf).tables())


@query("calendar", "A", with_star("""
SELECT CAST(unnest(generate_series(MIN(date_id), MAX(date_id), INTERVAL 1 DAY)) AS DATE) AS date_id
FROM fact_sales"""))
def _calendar(spark, sf):
    return calendar_of(star(spark, sf).fact.select("date_id"))
