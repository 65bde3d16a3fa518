"""Table sinks and sources."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACT_BUCKETS = 8             # of a test-sized load; a cluster load names its own count
FACT_PARTS = ["year", "month"]
_NAME = re.compile(r"(`[^`]+`|\w+)(\.(`[^`]+`|\w+)){0,2}")

# Star-schema DDL (the reference's tables under our names). Keys are not
# enforced by Spark; they are checked by operators/audit.py instead.
STAR_DDL = {
    "dim_product": "product_id STRING, name STRING, category STRING, ingredients STRING",
    "dim_sku": "sku_id STRING, product_id STRING, size STRING, price DECIMAL(6,2)",
    "dim_date": ("date_id DATE, year INT, quarter INT, month INT, month_name STRING, week INT, "
                 "day_of_month INT, day_of_week INT, day_name STRING, is_weekend INT"),
    "dim_time": "time_id INT, hour INT, minute INT, meal_period STRING",
    "fact_sales": ("line_id INT, order_id INT, date_id DATE, time_id INT, sku_id STRING, "
                   "product_id STRING, quantity INT, unit_price DECIMAL(6,2), "
                   "total_price DECIMAL(8,2), year INT, month INT"),
}


def create_schema(spark: SparkSession, database: str, location: str | None = None,
                  buckets: int = FACT_BUCKETS) -> list[str]:
    """CREATE DATABASE / TABLE IF NOT EXISTS for the five star tables (parquet).

    The fact is partitioned by year and month, so date filters and filtered
    date dimensions skip whole folders, and bucketed by order (``buckets``, 0
    for none), so work per order needs no exchange. A bucket is read by one
    task: load without buckets where one order may hold a large share of all
    lines.
    """
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{loc}")
    for name, cols in STAR_DDL.items():
        layout = ""
        if name == "fact_sales":
            layout = f" PARTITIONED BY ({', '.join(FACT_PARTS)})"
            if buckets:
                layout += f" CLUSTERED BY (order_id) SORTED BY (order_id) INTO {buckets} BUCKETS"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}) USING parquet{layout}")
    return list(STAR_DDL)


def with_date_parts(fact: DataFrame) -> DataFrame:
    """The fact with the partition columns of its date (last, as sinks need)."""
    plain = fact.drop(*FACT_PARTS)
    return plain.select("*", F.year("date_id").alias("year"), F.month("date_id").alias("month"))


def write_table(df: DataFrame, name: str, mode: str = "append",
                partition_by: list[str] | None = None, bucket_by: tuple[int, str] | None = None) -> None:
    """Append (the reference's load mode) or overwrite a catalog table.

    A new table takes the given partitions and buckets; an existing one keeps
    its own, and asking for other partitions is an error. ``insertInto`` keeps
    the declared table schema and matches columns by position, so the frame is
    projected to the table's column order first. Rows of a bucketed table are
    dealt by bucket, one task each, so a load leaves one file for each bucket
    and partition.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode {mode!r}: append or overwrite")
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        own = spark.catalog.listColumns(name)
        parts = [c.name for c in own if c.isPartition]
        if partition_by is not None and list(partition_by) != parts:
            raise ValueError(f"{name} is partitioned by {parts}, not {list(partition_by)}")
        keys = [c.name for c in own if c.isBucket]
        rows = df.select(*[f.name for f in spark.table(name).schema.fields])
        if keys:
            rows = rows.repartition(_bucket_count(spark, name), *keys)
        rows.write.insertInto(name, overwrite=(mode == "overwrite"))
        return
    if bucket_by:
        df = df.repartition(*bucket_by)
    w = df.write.mode(mode).format("parquet")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if bucket_by:
        w = w.bucketBy(*bucket_by).sortBy(bucket_by[1])
    w.saveAsTable(name)


def _bucket_count(spark: SparkSession, name: str) -> int:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0]["data_type"])


def table(spark: SparkSession, name_or_sql: str) -> DataFrame:
    """A catalog table, or the result of a SQL query, as a DataFrame. One to
    three dotted identifiers (in backticks, if they hold blanks) are a name."""
    text = name_or_sql.strip()
    return spark.table(text) if _NAME.fullmatch(text) else spark.sql(text)


def write_report(df: DataFrame, path: str, order_by: list[str] | None = None) -> None:
    """Write a small, already-aggregated report as a single CSV file with header.

    Only for report-sized frames (tens of rows): the single output file is the
    point of a report, and the frame is bounded by the reporting horizon.
    """
    out = df.orderBy(*order_by) if order_by else df
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    db = database or spark.catalog.currentDatabase()
    rows = [(db, t.name, t.tableType) for t in spark.catalog.listTables(db)]
    return spark.createDataFrame(rows, "database string, table_name string, table_type string")
