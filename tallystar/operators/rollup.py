"""One order table for all reports over time.

Every report over hours, periods, weekdays, months or days counts distinct
orders. The roll-up holds one row for each order (and date and time, should
one order have several): lines, units and money. It is aggregated once, with
map-side combine; written, it answers all of these reports from one scan of
the fact, with the same operators and the same exact rows, because units,
money and lines are sums and an order is still counted once.

For dashboards that accept a bound of a few per cent, ``order_sketches`` keeps
a HyperLogLog sketch of the orders of each day and hour; sketches of any set
of cells merge, so no distinct is run over orders at all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallystar.operators import sales, series
from tallystar.session import cut_lineage


def order_rollup(fact: DataFrame) -> DataFrame:
    """order_id, date_id, time_id, lines, quantity and total_price of each order."""
    parts = [c for c in ("year", "month") if c in fact.columns]
    return (fact.groupBy("order_id", "date_id", "time_id", *parts)
            .agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").cast("long").alias("quantity"),
                 F.sum("total_price").cast("decimal(15,2)").alias("total_price")))


def reports(fact: DataFrame, dim_date: DataFrame, dim_time: DataFrame) -> dict[str, DataFrame]:
    """The reports by name, all read from one written roll-up of the fact."""
    orders = cut_lineage(order_rollup(fact))
    return {
        "weekday_line_counts": sales.weekday_line_counts(orders, dim_date),
        "sales_by_hour": sales.sales_by_hour(orders, dim_time),
        "sales_by_meal_period": sales.sales_by_meal_period(orders, dim_time),
        "sales_by_weekday": sales.sales_by_weekday(orders, dim_date),
        "sales_by_month": sales.sales_by_month(orders, dim_date),
        "sales_heatmap": sales.sales_heatmap(orders, dim_date, dim_time),
        "daily_series": series.daily_series(orders, dim_date),
        "weekly_series": series.weekly_series(orders, dim_date),
        "monthly_series": series.monthly_series(orders, dim_date),
        "hourly_series": series.hourly_series(orders, dim_time),
        "daily_by_period": series.daily_by_period(orders, dim_time),
        "daily_by_weekday": series.daily_by_weekday(orders, dim_date),
    }


def order_sketches(fact: DataFrame, dim_time: DataFrame, precision: int = 12) -> DataFrame:
    """A mergeable sketch of the orders of each (date_id, hour)."""
    hours = F.broadcast(dim_time.select("time_id", "hour"))
    return (fact.join(hours, "time_id").groupBy("date_id", "hour")
            .agg(F.hll_sketch_agg("order_id", F.lit(precision)).alias("orders")))


def approximate_orders(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated orders by the given columns of the sketch table."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("orders").alias("orders"))
    return merged.withColumn("orders", F.hll_sketch_estimate("orders")).withColumnRenamed("orders", "about_orders")
