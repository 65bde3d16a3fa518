"""Raw order files: explicit schemas, never inferSchema.

The four files of the reference's raw layout map onto the star schema's
names: product type -> ``product_id``, SKU -> ``sku_id``. Times of day are
carried as seconds since midnight (Spark 4.1 keeps the TIME type off).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The raw files' column layout (names and order as exported).
PRODUCT_SCHEMA = "pizza_type_id string, name string, category string, ingredients string"
SKU_SCHEMA = "pizza_id string, pizza_type_id string, size string, price decimal(6,2)"
ORDER_SCHEMA = "order_id int, date string, time string"
LINE_SCHEMA = "order_details_id int, order_id int, pizza_id string, quantity int"


def _csv(spark: SparkSession, path: str, schema: str, encoding: str = "UTF-8") -> DataFrame:
    return (spark.read.option("header", True).option("encoding", encoding)
            .option("mode", "FAILFAST").schema(schema).csv(path))


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Product list; the source file is latin-1 encoded."""
    return _csv(spark, path, PRODUCT_SCHEMA, "ISO-8859-1")


def read_skus(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, SKU_SCHEMA)


def seconds_of_day(text) -> F.Column:
    """'HH:mm:ss' or 'HH:mm' -> seconds since midnight (NULL when unparsable)."""
    at = F.coalesce(F.try_to_timestamp(text, F.lit("HH:mm:ss")), F.try_to_timestamp(text, F.lit("HH:mm")))
    return (F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)).cast("int")


def read_orders(spark: SparkSession, path: str) -> DataFrame:
    """Order headers with the date parsed and the time as seconds of day."""
    raw = _csv(spark, path, ORDER_SCHEMA)
    return raw.select("order_id", F.to_date("date").alias("date_id"),
                      seconds_of_day(F.col("time")).alias("time_id"))


def read_order_lines(spark: SparkSession, path: str) -> DataFrame:
    return _csv(spark, path, LINE_SCHEMA)
