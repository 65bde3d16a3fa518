"""Operational sales aggregates over the star schema (peak, menu, size, upsell).

Plan rules used throughout:

* Broadcast hints only go on sides with a structural size bound: time of day
  (at most 86,400 seconds), calendar dates, literal tables. Menu-sized
  tables (products, SKUs) carry no hint: Spark checks their size against
  ``spark.sql.autoBroadcastJoinThreshold`` (static statistics, then AQE's
  runtime statistics) and falls back to a shuffled join when they are large.
* The fact is aggregated *before* it meets any dimension whose columns are
  only needed per group (menu, size, upsell), so joins run on a handful of
  aggregate rows instead of order lines.
* ``COUNT(DISTINCT order_id)`` is planned by Spark as a two-stage aggregate on
  (group, order_id) then (group), which spreads a hot group over many tasks.
* Windows without ``PARTITION BY`` (ranks, grand totals) only ever run over
  aggregates whose size is bounded by a dimension.
* Money is summed as DECIMAL; ratios are rounded from exact whole numbers
  (see ``functions.scalar.exact_round``) and cast to DOUBLE last.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.scalar import (MEAL_PERIOD_ORDER, SHARE_LABELS, SIZE_ORDER, cents,
                                        exact_round, from_cents, level_position, money,
                                        share_pct, strip_the)
from tallystar.operators.dates import on_date

B = F.broadcast


def _measures(orders: bool = True, units: bool = True, revenue: bool = True):
    out = []
    if orders:
        out.append(F.countDistinct("order_id").alias("total_orders"))
    if units:
        out.append(F.sum("quantity").cast("long").alias("total_units"))
    if revenue:
        out.append(F.sum(cents("total_price")).alias("rev_cents"))
    return out


def _lines(fact: DataFrame, column: str | None = None):
    """Line items: rows of the fact, or the counts that a roll-up of it holds."""
    if "lines" in fact.columns:
        return F.sum("lines" if column is None else F.when(F.col(column).isNotNull(), F.col("lines")))
    return F.count(F.lit(1) if column is None else F.col(column))


def _finish(df: DataFrame, aov: bool = False) -> DataFrame:
    """Turn the DECIMAL revenue into the reported columns."""
    if aov:
        df = df.withColumn("avg_order_value",
                           exact_round("rev_cents", F.col("total_orders") * 100, 2))
    return df.withColumn("total_revenue", from_cents("rev_cents")).drop("rev_cents")


# --------------------------------------------------------------------- D0
def weekday_line_counts(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Line items per weekday (the reference names this total_orders; it counts lines)."""
    return (on_date(fact, dim_date, "day_name", "day_of_week")
            .groupBy("day_name", "day_of_week")
            .agg(_lines(fact, "order_id").alias("line_items"))
            .orderBy("day_of_week"))


# --------------------------------------------------------------------- D1
def sales_by_hour(fact: DataFrame, dim_time: DataFrame, avg: str = "line") -> DataFrame:
    """Orders, units, revenue and an average per hour of day.

    ``avg="line"``: revenue / line items; ``avg="unit"``: revenue / units.
    """
    df = (fact.join(B(dim_time), "time_id").groupBy("hour")
          .agg(*_measures(), _lines(fact).alias("lines")))
    if avg == "line":
        df = df.withColumn("avg_line_item_value",
                           exact_round("rev_cents", F.col("lines") * 100, 2))
    elif avg == "unit":
        df = df.withColumn("avg_unit_value",
                           exact_round("rev_cents", F.col("total_units") * 100, 2))
    else:
        raise ValueError(avg)
    return _finish(df).drop("lines").orderBy("hour")


def label_hours(hourly: DataFrame) -> DataFrame:
    """``hourly`` with its hour as a clock label (09:00)."""
    return hourly.withColumn("hour_label", F.format_string("%02d:00", F.col("hour").cast("int")))


# --------------------------------------------------------------------- D2
def sales_by_meal_period(fact: DataFrame, dim_time: DataFrame,
                         exclude: Sequence[str] = ()) -> DataFrame:
    dt = dim_time.select("time_id", "meal_period")
    if exclude:
        # Filtering the dimension prunes the fact through the broadcast join.
        dt = dt.filter(~F.col("meal_period").isin(*exclude))
    df = fact.join(B(dt), "time_id").groupBy("meal_period").agg(*_measures())
    return (_finish(df, aov=True)
            .orderBy(level_position("meal_period", MEAL_PERIOD_ORDER)))


# --------------------------------------------------------------------- D3
def sales_by_weekday(fact: DataFrame, dim_date: DataFrame, units: bool = True) -> DataFrame:
    df = (on_date(fact, dim_date, "day_name", "day_of_week").groupBy("day_name", "day_of_week")
          .agg(*_measures(units=units)))
    return _finish(df, aov=True).orderBy("day_of_week")


def weekday_levels(dim_date: DataFrame) -> DataFrame:
    """Distinct (day_name, day_of_week) in weekday order: the factor levels."""
    return dim_date.select("day_name", "day_of_week").distinct().orderBy("day_of_week")


# --------------------------------------------------------------------- D4
def sales_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    df = (on_date(fact, dim_date, "month", "month_name").groupBy("month", "month_name")
          .agg(*_measures()))
    return _finish(df).orderBy("month")


# --------------------------------------------------------------------- D5
def sales_heatmap(fact: DataFrame, dim_date: DataFrame, dim_time: DataFrame,
                  min_hour: int | None = None, orders_only: bool = False) -> DataFrame:
    dt = dim_time.select("time_id", "hour")
    if min_hour is not None:
        dt = dt.filter(F.col("hour") >= min_hour)
    df = (on_date(fact, dim_date, "day_name", "day_of_week")
          .join(B(dt), "time_id")
          .groupBy("day_name", "day_of_week", "hour")
          .agg(*_measures(units=not orders_only, revenue=not orders_only)))
    if not orders_only:
        df = _finish(df)
    return df.orderBy("day_of_week", "hour")


# --------------------------------------------------------------------- D6
def product_totals(fact: DataFrame) -> DataFrame:
    """Per-product units, revenue, line count and summed unit price (partial-aggregated)."""
    return (fact.groupBy("product_id")
            .agg(F.sum("quantity").cast("long").alias("total_quantity"),
                 F.sum(cents("total_price")).alias("rev_cents"),
                 F.sum(cents("unit_price")).alias("up_cents"),
                 F.count(F.lit(1)).alias("lines")))


def menu_ranking(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Units, revenue, average unit price and RANK() by units and by revenue.

    Grouped by (name, category) as the reference does; the rank windows run
    over that menu-sized aggregate only.
    """
    per_name = (product_totals(fact).join(dim_product, "product_id")
                .groupBy("name", "category")
                .agg(F.sum("total_quantity").cast("long").alias("total_quantity"),
                     F.sum("rev_cents").alias("rev_cents"),
                     F.sum("up_cents").alias("up_cents"),
                     F.sum("lines").alias("lines")))
    return (per_name
            .withColumn("avg_unit_price",
                        exact_round("up_cents", F.col("lines") * 100, 2))
            .withColumn("volume_rank", F.rank().over(Window.orderBy(F.desc("total_quantity"))))
            .withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("rev_cents"))))
            .withColumn("total_revenue", from_cents("rev_cents"))
            .select("name", "category", "total_quantity", "total_revenue", "avg_unit_price",
                    "volume_rank", "revenue_rank")
            .orderBy(F.desc("total_revenue"), "name"))


def rank_divergence(ranking: DataFrame, zero_is_above: bool = True) -> DataFrame:
    """volume_rank - revenue_rank; positive means revenue rank is better."""
    d = F.col("volume_rank") - F.col("revenue_rank")
    above = d >= 0 if zero_is_above else d > 0
    return (ranking.withColumn("rank_divergence", d.cast("int"))
            .withColumn("direction", F.when(above, "earns above volume weight")
                        .otherwise("sells above revenue weight"))
            .withColumn("short_name", strip_the("name"))
            .orderBy("rank_divergence", "name"))


def top_n_by_revenue(ranking: DataFrame, n: int = 5) -> DataFrame:
    """Head n of the ranking (the report's top-k; ties broken by name), a
    distributed top-n."""
    return (ranking.select("name", "category", "total_quantity", "total_revenue", "volume_rank", "revenue_rank")
            .orderBy(F.desc("total_revenue"), "name").limit(n))


# --------------------------------------------------------------------- D7
def menu_bottom_n(fact: DataFrame, dim_product: DataFrame, n: int | None = 7,
                  share: float | None = None) -> DataFrame:
    """Lowest-revenue products. ``n`` fixed (a distributed top-n), or ``share``
    of the menu rounded up."""
    per_name = (product_totals(fact).join(dim_product, "product_id")
                .groupBy("name", "category")
                .agg(F.sum("total_quantity").cast("long").alias("total_quantity"),
                     F.sum("rev_cents").alias("rev_cents")))
    if share is None:
        lowest = per_name.orderBy("rev_cents", "name").limit(n)
    else:
        limit = F.ceil(F.lit(share) * F.count(F.lit(1)).over(Window.partitionBy()))
        ranked = per_name.withColumn("_rn", F.row_number().over(Window.orderBy("rev_cents", "name")))
        lowest = ranked.withColumn("_limit", limit).filter(F.col("_rn") <= F.col("_limit"))
    return (lowest.select("name", "category", "total_quantity",
                    from_cents("rev_cents").alias("total_revenue"))
            .orderBy("total_revenue", "name"))


# --------------------------------------------------------------------- D8
def category_performance(fact: DataFrame, dim_product: DataFrame,
                         total: str = "window") -> DataFrame:
    """Menu items, units, revenue, revenue per unit and share of revenue per category.

    ``total="window"``: grand total as ``SUM(SUM(x)) OVER ()`` on the
    category aggregate. ``total="subquery"``: grand total over the whole
    fact as a scalar subquery (Spark runs it once and inlines the value).
    """
    per_product = product_totals(fact).select("product_id", "total_quantity", "rev_cents")
    df = (per_product.join(dim_product.select("product_id", "category"), "product_id")
          .groupBy("category")
          .agg(F.count(F.lit(1)).alias("menu_items"),
               F.sum("total_quantity").cast("long").alias("total_quantity"),
               F.sum("rev_cents").alias("rev_cents")))
    if total == "window":
        grand = F.sum("rev_cents").over(Window.partitionBy())
    elif total == "subquery":
        grand = fact.agg(F.sum(cents("total_price"))).scalar()
    else:
        raise ValueError(total)
    df = df.withColumn("_grand", grand)
    return (df.withColumn("avg_revenue_per_unit",
                          exact_round("rev_cents", F.col("total_quantity") * 100, 2))
            .withColumn("revenue_share_pct", share_pct("rev_cents", "_grand"))
            .withColumn("total_revenue", from_cents("rev_cents")).drop("rev_cents", "_grand")
            .orderBy(F.desc("total_revenue"), "category"))


# --------------------------------------------------------------------- D9
def low_sellers(dim_product: DataFrame, fact: DataFrame, max_units: int = 500) -> DataFrame:
    """Every product (sold or not) whose units are below ``max_units``.

    The fact is reduced to one row per product first; the LEFT JOIN from the
    product list then runs on menu-sized inputs.
    """
    totals = product_totals(fact).select("product_id", "total_quantity", "rev_cents")
    return (dim_product.join(totals, "product_id", "left")
            .select("product_id", "name", "category",
                    F.coalesce("total_quantity", F.lit(0).cast("long")).alias("total_quantity"),
                    F.coalesce(from_cents("rev_cents"), F.lit(0.0)).alias("total_revenue"))
            .filter(F.col("total_quantity") < max_units)
            .orderBy("total_quantity", "product_id"))


# --------------------------------------------------------------------- D10
def size_performance(fact: DataFrame, dim_sku: DataFrame, total: str = "window") -> DataFrame:
    per_sku = (fact.groupBy("sku_id")
               .agg(F.sum("quantity").cast("long").alias("q"), F.sum(cents("total_price")).alias("r"),
                    F.sum(cents("unit_price")).alias("u"), F.count(F.lit(1)).alias("n")))
    df = (per_sku.join(dim_sku.select("sku_id", "size"), "sku_id")
          .groupBy("size")
          .agg(F.sum("q").cast("long").alias("total_quantity"), F.sum("r").alias("rev_cents"),
               F.sum("u").alias("up_cents"), F.sum("n").alias("lines")))
    if total == "window":
        w = Window.partitionBy()
        units_total, rev_total = F.sum("total_quantity").over(w), F.sum("rev_cents").over(w)
    elif total == "subquery":
        units_total = fact.agg(F.sum("quantity")).scalar()
        rev_total = fact.agg(F.sum(cents("total_price"))).scalar()
    else:
        raise ValueError(total)
    df = df.withColumn("_units_total", units_total).withColumn("_rev_total", rev_total)
    return (df.withColumn("avg_unit_price",
                          exact_round("up_cents", F.col("lines") * 100, 2))
            .withColumn("volume_share_pct", share_pct("total_quantity", "_units_total"))
            .withColumn("revenue_share_pct", share_pct("rev_cents", "_rev_total"))
            .withColumn("total_revenue", from_cents("rev_cents"))
            .select("size", "total_quantity", "total_revenue", "avg_unit_price",
                    "volume_share_pct", "revenue_share_pct")
            .orderBy(level_position("size", SIZE_ORDER)))


def size_share_long(size_perf: DataFrame) -> DataFrame:
    """Wide -> long over the two share columns, with display labels."""
    long = size_perf.unpivot(["size"], list(SHARE_LABELS), "metric", "share_pct")
    label = None
    for key, text in SHARE_LABELS.items():
        label = (F.when(F.col("metric") == key, text) if label is None
                 else label.when(F.col("metric") == key, text))
    return (long.withColumn("metric", label)
            .orderBy(level_position("size", SIZE_ORDER), "metric"))


# --------------------------------------------------------------------- D11
def size_mix_by_category(fact: DataFrame, dim_sku: DataFrame, dim_product: DataFrame) -> DataFrame:
    per = (fact.groupBy("sku_id", "product_id")
           .agg(F.sum("quantity").cast("long").alias("q"), F.sum(cents("total_price")).alias("r")))
    df = (per.join(dim_sku.select("sku_id", "size"), "sku_id")
          .join(dim_product.select("product_id", "category"), "product_id")
          .groupBy("category", "size")
          .agg(F.sum("q").cast("long").alias("total_quantity"), F.sum("r").alias("rev_cents")))
    df = df.withColumn("_cat_total", F.sum("total_quantity").over(Window.partitionBy("category")))
    return (df.withColumn("volume_share_within_category", share_pct("total_quantity", "_cat_total"))
            .drop("_cat_total")
            .withColumn("total_revenue", from_cents("rev_cents")).drop("rev_cents")
            .orderBy("category", level_position("size", SIZE_ORDER)))


# --------------------------------------------------------------------- D12
def upsell_base(dim_product: DataFrame, dim_sku: DataFrame, fact: DataFrame,
                frm: str = "M", to: str = "L", rate: str | None = "0.10") -> DataFrame:
    """Price gap between two sizes of each product and the units sold at the smaller one.

    Price-list form: a product qualifies when both sizes are on the price
    list and the product has at least one sale.
    """
    pm = dim_sku.filter(F.col("size") == frm).select("product_id", F.col("sku_id").alias("m_sku"),
                                                      F.col("price").alias("m_price"))
    pl = dim_sku.filter(F.col("size") == to).select("product_id", F.col("price").alias("l_price"))
    # One pass over the fact: units per (product, SKU), then per product the
    # units of its smaller-size SKU. A product with any sale keeps its row.
    sold = (fact.groupBy("product_id", "sku_id").agg(F.sum("quantity").cast("long").alias("q"))
            .join(pm.select("product_id", "m_sku"), "product_id")
            .groupBy("product_id")
            .agg(F.sum(F.when(F.col("sku_id") == F.col("m_sku"), F.col("q")).otherwise(0))
                 .cast("long").alias("medium_quantity_sold")))
    df = (dim_product.join(pm, "product_id").join(pl, "product_id")
          .join(sold, "product_id")
          .groupBy("name", "category", "m_price", "l_price")
          .agg(F.sum("medium_quantity_sold").cast("long").alias("medium_quantity_sold")))
    gap = F.col("l_price") - F.col("m_price")
    df = df.withColumn("price_gap", gap)
    if rate is not None:
        df = df.withColumn("upsell_revenue",
                           F.round(F.col("medium_quantity_sold") * F.lit(Decimal(rate)) * gap, 2)
                           .cast("double"))
    # With a rate: the report columns. Without: also the exact DECIMAL gap,
    # which the scenario sums need.
    extra = [F.col("upsell_revenue")] if rate is not None else [F.col("price_gap").alias("price_gap_dec")]
    return (df.select("name", "category", money("m_price").alias("medium_price"),
                      money("l_price").alias("large_price"), money("price_gap").alias("price_gap"),
                      "medium_quantity_sold", *extra)
            .orderBy(*([F.desc("upsell_revenue")] if rate is not None else []), "name"))


def upsell_base_from_sales(fact: DataFrame, dim_sku: DataFrame, dim_product: DataFrame,
                           frm: str = "M", to: str = "L") -> DataFrame:
    """Same base from sold SKUs only: conditional MAX pivots, both prices required."""
    sku_units = fact.groupBy("sku_id", "product_id").agg(F.sum("quantity").cast("long").alias("q"))
    df = (sku_units.join(dim_sku.select("sku_id", "size", "price"), "sku_id")
          .join(dim_product.select("product_id", "name", "category"), "product_id")
          .groupBy("name", "category")
          .agg(F.max(F.when(F.col("size") == frm, F.col("price"))).alias("m_price"),
               F.max(F.when(F.col("size") == to, F.col("price"))).alias("l_price"),
               F.sum(F.when(F.col("size") == frm, F.col("q")).otherwise(0)).cast("long")
               .alias("medium_quantity_sold"))
          .filter(F.col("m_price").isNotNull() & F.col("l_price").isNotNull()))
    return df.select("name", "category", money("m_price").alias("medium_price"),
                     money("l_price").alias("large_price"),
                     money(F.col("l_price") - F.col("m_price")).alias("price_gap"),
                     "medium_quantity_sold").orderBy("name")


# --------------------------------------------------------------------- D13
DEFAULT_RATES = ("0.05", "0.10", "0.15", "0.20")


def rate_label(rate) -> F.Column:
    """0.05 -> '5%', 0.125 -> '12.5%' (trailing zeros trimmed)."""
    pct = (rate * F.lit(100)).cast("decimal(10,2)").cast("string")
    return F.concat(F.regexp_replace(pct, r"\.?0+$", ""), F.lit("%"))


def upsell_scenarios(base: DataFrame, rates: Sequence[str] = DEFAULT_RATES,
                     round_rows: bool = True) -> DataFrame:
    """Total upsell revenue per conversion rate.

    ``base`` needs exact DECIMAL ``price_gap_dec`` and ``medium_quantity_sold``
    (use :func:`upsell_base_exact`). Rates are expanded with a generator on
    the base rows (no join). ``round_rows`` rounds every product row to cents
    half-even before summing (notebook form); otherwise the sum is exact.
    """
    r = F.explode(F.array(*[F.lit(Decimal(x)).cast("decimal(5,4)") for x in rates])).alias("rate")
    rows = base.select("*", r)
    value = F.col("medium_quantity_sold") * F.col("rate") * F.col("price_gap_dec")
    if round_rows:
        value = F.bround(value, 2)
    return (rows.groupBy("rate").agg(F.sum(value).alias("total_dec"))
            .select(rate_label(F.col("rate")).alias("conversion_rate"),
                    F.col("rate").cast("double").alias("rate"),
                    money("total_dec").alias("total_upsell_revenue"))
            .orderBy("rate"))


def upsell_base_exact(dim_product: DataFrame, dim_sku: DataFrame, fact: DataFrame,
                      frm: str = "M", to: str = "L") -> DataFrame:
    """Upsell base with the exact DECIMAL price gap kept for scenario sums."""
    return upsell_base(dim_product, dim_sku, fact, frm, to, rate=None)


# --------------------------------------------------------------------- D14
def with_attributes(df: DataFrame, attributes: DataFrame, key: str,
                    defaults: dict | None = None) -> DataFrame:
    """LEFT JOIN a small literal attribute table; unmatched keys get defaults."""
    out = df.join(B(attributes), key, "left")
    for c, v in (defaults or {}).items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v)))
    return out
