"""Materialise the star schema once, then let every query read parquet.

This is the Spark form of the reference's load step: the expensive
lineitem x orders x part join runs once, its result is written as parquet to
the shared folder the cluster names in ``spark.checkpoint.dir`` and every
later query scans that copy (with column pruning and predicate pushdown).
Writing a table also cuts the lineage, so a lost executor recomputes from
the written files rather than from the raw join.
"""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tallystar.session import ensure_checkpoint_dir
from tallystar.sources.tables import FACT_BUCKETS

SOURCES = ("lineitem", "orders", "part")

# (application, folder) -> (where the copy is, state of the source files when it was made)
_BUILT: dict[tuple[str, str], tuple[str, str]] = {}


def _key(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    return (spark.sparkContext.applicationId, os.path.abspath(sf_dir))


def _state(spark: SparkSession, sf_dir: str) -> str:
    """Names, sizes and times of the source files: a copy of other files is stale."""
    found = []
    for name in SOURCES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        for f in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path):
            found.append(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}")
    return hashlib.sha1("|".join(found).encode()).hexdigest()


def _target(spark: SparkSession, sf_dir: str) -> str:
    root = ensure_checkpoint_dir(spark).rstrip("/")
    tag = hashlib.sha1(os.path.abspath(sf_dir).encode()).hexdigest()[:12]
    return f"{root}/star-{tag}"


def build(spark: SparkSession, sf_dir: str, target: str | None = None) -> str:
    """Write fact and dimensions as parquet and register them for ``sf_dir``.

    The time dimension comes from the order headers (one narrow scan).
    """
    from tallystar.sources.testdata import (dim_date_from_dates, dim_product, dim_sku,
                                            dim_time_from_ids, fact_sales, order_times,
                                            read_table)

    part = read_table(spark, sf_dir, "part")
    orders = read_table(spark, sf_dir, "orders")
    target = target or _target(spark, sf_dir)
    state = _state(spark, sf_dir)
    sku = dim_sku(part)
    sku.write.mode("overwrite").parquet(f"{target}/dim_sku")
    sku = spark.read.parquet(f"{target}/dim_sku")
    fact = fact_sales(read_table(spark, sf_dir, "lineitem"), orders, part, sku)
    # Sorting inside each output file (no extra shuffle) keeps parquet
    # min/max statistics tight on date, so date filters skip row groups.
    (fact.sortWithinPartitions("date_id", "order_id")
     .write.mode("overwrite").parquet(f"{target}/fact_sales"))
    dim_product(part).write.mode("overwrite").parquet(f"{target}/dim_product")
    dates = orders.select(F.col("o_orderdate").cast("date").alias("date_id")).distinct()
    dim_date_from_dates(dates).write.mode("overwrite").parquet(f"{target}/dim_date")
    dim_time_from_ids(order_times(orders)) \
        .write.mode("overwrite").parquet(f"{target}/dim_time")
    _BUILT[_key(spark, sf_dir)] = (target, state)
    return target


def forget(spark: SparkSession, sf_dir: str) -> None:
    _BUILT.pop(_key(spark, sf_dir), None)


def lookup(spark: SparkSession, sf_dir: str):
    from tallystar.sources.testdata import Star

    target, state = _BUILT.get(_key(spark, sf_dir), (None, None))
    if target is None or state != _state(spark, sf_dir):
        return None
    r = spark.read.parquet
    return Star(fact=r(f"{target}/fact_sales"), dim_sku=r(f"{target}/dim_sku"),
                dim_product=r(f"{target}/dim_product"), dim_date=r(f"{target}/dim_date"),
                dim_time=r(f"{target}/dim_time"))


# Raw file names of the reference's order export (fixed values).
RAW_FILES = {"products": "pizza_types.csv", "skus": "pizzas.csv", "orders": "orders.csv",
             "lines": "order_details.csv"}


def star_from_csv(spark: SparkSession, raw_dir: str, files: dict[str, str] | None = None):
    """The star schema built from the four raw order files (lazy frames)."""
    from tallystar.operators import warehouse as wh
    from tallystar.sources import csv
    from tallystar.sources.testdata import Star

    f = {**RAW_FILES, **(files or {})}
    path = lambda k: f"{raw_dir.rstrip('/')}/{f[k]}"
    sku = wh.build_dim_sku(csv.read_skus(spark, path("skus")))
    orders = csv.read_orders(spark, path("orders"))
    return Star(fact=wh.build_fact(csv.read_order_lines(spark, path("lines")), orders, sku),
                dim_sku=sku,
                dim_product=wh.build_dim_product(csv.read_products(spark, path("products"))),
                dim_date=wh.build_dim_date(orders), dim_time=wh.build_dim_time(orders))


def load_from_csv(spark: SparkSession, raw_dir: str, database: str, mode: str = "overwrite",
                  location: str | None = None, buckets: int = FACT_BUCKETS):
    """The reference's load job: create the schema if needed, write the five
    tables (dimensions first; the fact by year and month, in buckets of
    orders), return their row counts as a DataFrame."""
    from tallystar.operators.warehouse import row_counts
    from tallystar.sources.tables import create_schema, table, with_date_parts, write_table

    create_schema(spark, database, location, buckets)
    star = star_from_csv(spark, raw_dir)
    for name in ("dim_product", "dim_sku", "dim_date", "dim_time", "fact_sales"):
        rows = star.tables()[name]
        write_table(with_date_parts(rows) if name == "fact_sales" else rows, f"{database}.{name}", mode=mode)
    return row_counts({n: table(spark, f"{database}.{n}") for n in star.tables()})


def star_from_catalog(spark: SparkSession, database: str):
    """The five loaded tables of ``database`` as a Star."""
    from tallystar.sources.testdata import Star

    t = lambda n: spark.table(f"{database}.{n}")
    return Star(fact=t("fact_sales"), dim_sku=t("dim_sku"), dim_product=t("dim_product"),
                dim_date=t("dim_date"), dim_time=t("dim_time"))
