"""Data-quality audits of the star schema.

Spark does not enforce keys, so primary/foreign keys become checks. Each
check is one Spark job over the table it inspects:

* NULL counts take one pass per table (all columns summed together), then an
  unpivot; never one scan per column.
* Orphan checks are LEFT ANTI joins against the dimension keys (Spark's
  size check decides whether the dimension side is broadcast).
* Key-duplicate checks compare ``count(*)`` with ``count(DISTINCT key)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.functions.scalar import (MEAL_PERIOD_ORDER, cents, exact_round, from_cents,
                                        level_position)

B = F.broadcast


def _status(c: F.Column) -> F.Column:
    return F.when(c, "PASS").otherwise("FAIL")


def _union_all(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# C1 / B7 -----------------------------------------------------------------
def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``count(*)`` of each table, one row per table (jobs run as one union)."""
    return _union_all([df.agg(F.count(F.lit(1)).alias("row_count"))
                       .select(F.lit(name).alias("table_name"), "row_count")
                       for name, df in tables.items()])


def audit_counts(spark: SparkSession, tables: Mapping[str, DataFrame],
                 expected: Mapping[str, int]) -> DataFrame:
    exp = spark.createDataFrame([(k, int(v)) for k, v in expected.items()],
                                "table_name string, expected long")
    return (exp.join(row_counts({k: tables[k] for k in expected}), "table_name", "left")
            .select("table_name", "expected", F.col("row_count").alias("actual"),
                    _status(F.col("row_count") == F.col("expected")).alias("status")))


def audit_counts_against(tables: Mapping[str, DataFrame], source: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of ``tables`` against those of the frames they were loaded from."""
    expected = row_counts(source).withColumnRenamed("row_count", "expected")
    return (expected.join(row_counts(tables), "table_name", "left")
            .select("table_name", "expected", F.col("row_count").alias("actual"),
                    _status(F.col("row_count") == F.col("expected")).alias("status")))


# C2 ----------------------------------------------------------------------
def audit_nulls(tables: Mapping[str, DataFrame], checks: Sequence[tuple[str, str]]) -> DataFrame:
    by_table: dict[str, list[str]] = {}
    for t, c in checks:
        by_table.setdefault(t, []).append(c)
    parts = []
    for t, cols in by_table.items():
        wide = tables[t].agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
        parts.append(wide.unpivot([], cols, "column_name", "null_count")
                     .select(F.lit(t).alias("table_name"), "column_name",
                             F.coalesce("null_count", F.lit(0).cast("long")).alias("null_count")))
    out = _union_all(parts)
    return out.withColumn("status", _status(F.col("null_count") == 0))


# C3 ----------------------------------------------------------------------
def audit_orphans(fact: DataFrame, relations: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """Rows of ``fact`` whose key has no match in the dimension.

    One scan of the fact: each dimension's distinct keys are LEFT-joined
    with a marker column (Spark's size check decides broadcast vs shuffle),
    and all checks are counted in a single aggregate, then unpivoted.
    """
    f = fact.select(*{key for _, _, key in relations})
    names = []
    for i, (name, dim, key) in enumerate(relations):
        flag = f"_hit{i}"
        f = f.join(dim.select(key).distinct().withColumn(flag, F.lit(True)), key, "left")
        names.append((name, flag))
    counts = f.agg(*[F.count_if(F.col(flag).isNull()).alias(f"c{i}")
                     for i, (_, flag) in enumerate(names)])
    long = counts.unpivot([], [f"c{i}" for i in range(len(names))], "_c", "orphaned_rows")
    labels = None
    for i, (name, _) in enumerate(names):
        labels = (F.when(F.col("_c") == f"c{i}", name) if labels is None
                  else labels.when(F.col("_c") == f"c{i}", name))
    return (long.select(labels.alias("check_name"), "orphaned_rows")
            .withColumn("status", _status(F.col("orphaned_rows") == 0)))


# C4 ----------------------------------------------------------------------
def date_coverage(fact: DataFrame) -> DataFrame:
    """First and last day, days, orders and lines. The fact is grouped by date
    and by order once each, with map-side combine; two COUNT DISTINCT in one
    aggregate would send every row three times."""
    lines = fact.groupBy("order_id", "date_id").agg(F.count(F.lit(1)).alias("lines"))
    orders = lines.groupBy("order_id").agg(F.sum("lines").alias("lines"), F.collect_set("date_id").alias("days"))
    # An order has one date or few, so a task's days stay a short list.
    days = orders.groupBy("days").agg(F.sum("lines").alias("lines"), F.count("order_id").alias("orders"))
    return (days.select("lines", "orders", F.posexplode_outer("days").alias("at", "date_id"))
            .groupBy("date_id").agg(F.sum(F.when(F.coalesce("at", F.lit(0)) == 0, F.col("lines"))).alias("lines"),
                                    F.sum(F.when(F.coalesce("at", F.lit(0)) == 0, F.col("orders"))).alias("orders"))
            .agg(F.min("date_id").alias("first_order_date"), F.max("date_id").alias("last_order_date"),
                 F.count("date_id").alias("trading_days"), F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
                 F.coalesce(F.sum("lines"), F.lit(0)).alias("total_line_items"))
            .withColumn("date_span_days",
                        F.datediff("last_order_date", "first_order_date").cast("int")))


# C5 ----------------------------------------------------------------------
def zero_days(dim_date: DataFrame, fact: DataFrame) -> DataFrame:
    """Dimension dates without a single fact row (anti join; count is 0 by construction)."""
    return (dim_date.select("date_id", "day_name")
            .join(fact.select("date_id").distinct(), "date_id", "left_anti")
            .withColumn("order_count", F.lit(0).cast("long"))
            .orderBy("date_id"))


# C6 / C7 -------------------------------------------------------------------
def period_counts(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    return (fact.join(B(dim_time.select("time_id", "meal_period")), "time_id")
            .groupBy("meal_period")
            .agg(F.count(F.lit(1)).alias("line_items"),
                 F.countDistinct("order_id").alias("unique_orders"))
            .orderBy(F.desc("line_items"), "meal_period"))


def order_by_levels(df: DataFrame, column: str, levels: Sequence[str],
                    unlisted_last: bool = True) -> DataFrame:
    """Drop NULL levels and sort by an explicit level order (an ordered factor).

    Unlisted values get position 0 (MySQL FIELD); ``unlisted_last`` moves them
    after the listed ones.
    """
    pos = level_position(column, levels)
    if unlisted_last:
        pos = F.when(pos == 0, F.lit(len(levels) + 1)).otherwise(pos)
    return (df.dropna(subset=[column]).withColumn("level_order", pos.cast("int"))
            .orderBy("level_order", column))


def meal_period_levels(df: DataFrame) -> DataFrame:
    return order_by_levels(df, "meal_period", MEAL_PERIOD_ORDER)


# C8 / C9 -------------------------------------------------------------------
def quantity_stats(fact: DataFrame) -> DataFrame:
    return (fact.agg(F.min("quantity").alias("min_qty"), F.max("quantity").alias("max_qty"),
                     F.sum("quantity").alias("_s"), F.count("quantity").alias("_n"),
                     F.count_if(F.col("quantity") <= 0).alias("zero_or_negative"),
                     F.count_if(F.col("quantity") > 10).alias("qty_over_10"))
            .withColumn("avg_qty", exact_round("_s", "_n", 2)).drop("_s", "_n"))


def quantity_hist(fact: DataFrame) -> DataFrame:
    return (fact.groupBy("quantity").agg(F.count(F.lit(1)).alias("frequency"))
            .orderBy("quantity"))


# C10 ---------------------------------------------------------------------
def price_conflicts(df: DataFrame, key: str, price: str) -> DataFrame:
    """Keys with more than one distinct price, with the price range."""
    return (df.groupBy(key)
            .agg(F.countDistinct(price).alias("distinct_prices"),
                 F.min(price).cast("double").alias("min_price"),
                 F.max(price).cast("double").alias("max_price"))
            .filter(F.col("distinct_prices") > 1)
            .orderBy(F.desc("distinct_prices"), key))


# C11 ---------------------------------------------------------------------
def size_audit(fact: DataFrame, dim_sku: DataFrame) -> DataFrame:
    per_sku = (fact.groupBy("sku_id")
               .agg(F.count(F.lit(1)).alias("n"), F.sum(cents("total_price")).alias("r"),
                    F.sum(cents("unit_price")).alias("u")))
    return (per_sku.join(dim_sku.select("sku_id", "size"), "sku_id")
            .groupBy("size")
            .agg(F.sum("n").alias("line_items"), F.sum("r").alias("_rev"), F.sum("u").alias("_up"))
            .select("size", "line_items", from_cents("_rev").alias("total_revenue"),
                    exact_round("_up", F.col("line_items") * 100, 2).alias("avg_price"))
            .orderBy(F.desc("line_items"), "size"))


# C12 ---------------------------------------------------------------------
def unsold_skus(dim_sku: DataFrame, dim_product: DataFrame, fact: DataFrame) -> DataFrame:
    """SKUs on the price list that never appear in the fact."""
    return (dim_sku.select("sku_id", "product_id", "size")
            .join(dim_product.select("product_id", "name"), "product_id")
            .join(fact.select("sku_id").distinct(), "sku_id", "left_anti")
            .select("sku_id", "name", "size", F.lit(0).cast("long").alias("times_ordered"))
            .orderBy("name", "size"))


# C13 ---------------------------------------------------------------------
def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return (df.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.countDistinct(F.struct(*keys)).alias("unique_ids"))
            .withColumn("duplicates", F.col("total_rows") - F.col("unique_ids"))
            .withColumn("status", _status(F.col("duplicates") == 0)))


# C14 ---------------------------------------------------------------------
def summary(fact: DataFrame) -> DataFrame:
    return (fact.agg(F.countDistinct("order_id").alias("total_orders"),
                     F.count(F.lit(1)).alias("total_line_items"),
                     F.sum(cents("total_price")).alias("_rev"),
                     F.min("date_id").alias("period_start"), F.max("date_id").alias("period_end"))
            .select("total_orders", "total_line_items", from_cents("_rev").alias("total_revenue"),
                    exact_round("_rev", F.col("total_line_items") * 100, 2)
                    .alias("avg_line_item_value"), "period_start", "period_end"))
