"""Audits and screens over a star with faults, so that their rows are not empty.

The test tables are clean, and checks on them mostly report nothing. Here the
fact is derived from the same tables by fixed rules on its own keys (lines of
some days, SKUs and products are left out; keys are blanked, made unknown, or
doubled; some prices differ), and every check runs the ordinary operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.operators import audit, basket, sales
from tallystar.plans.oracle_sql import with_star
from tallystar.plans.q_audit import FK_CHECKS, NULL_CHECKS
from tallystar.plans.q_basket import _CORR, _DAILY, _LIFT_CTES, _WITHIN, _items
from tallystar.plans.registry import query
from tallystar.sources.testdata import read_table
from tallystar.sources.testdata import star_from_dir as star

# Rules over the clean fact, read by both engines: lines of the 13th of a month
# and of XXL SKUs are left out, the others change one field or double a line.
UNKNOWN_SKU, BLANK_SKU, BLANK_PRICE, DEARER, TWICE = ("order_id % 89 = 5", "order_id % 97 = 1", "order_id % 101 = 3",
                                                      "order_id % 83 = 2", "order_id % 73 = 4")

_FAULTY = f"""
faulty AS (
  SELECT order_id, line_no, date_id, time_id,
         CASE WHEN {BLANK_SKU} THEN NULL WHEN {UNKNOWN_SKU} THEN concat('none_', sku_id) ELSE sku_id END AS sku_id,
         CASE WHEN {UNKNOWN_SKU} THEN concat('none_', product_id) ELSE product_id END AS product_id, quantity,
         CASE WHEN {BLANK_PRICE} THEN NULL WHEN {DEARER} THEN CAST(unit_price + 1 AS DECIMAL(8,2))
              ELSE CAST(unit_price AS DECIMAL(8,2)) END AS unit_price, total_price
  FROM fact_sales, range(2) r(copy)
  WHERE NOT (dayofmonth(date_id) = 13 OR ends_with(sku_id, '_XXL')) AND (copy = 0 OR {TWICE}))"""


def faulty_fact(fact: DataFrame) -> DataFrame:
    """The fact with the faults above; doubled lines by a generator, not a union."""
    kept = fact.where(~F.coalesce((F.dayofmonth("date_id") == 13) | F.endswith("sku_id", F.lit("_XXL")), F.lit(False)))
    copies = F.explode(F.when(F.expr(TWICE), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    none = lambda c: F.concat(F.lit("none_"), F.col(c))
    return kept.withColumn("_copy", copies).select(
        "order_id", "line_no", "date_id", "time_id",
        F.when(~F.expr(BLANK_SKU), F.when(F.expr(UNKNOWN_SKU), none("sku_id")).otherwise(F.col("sku_id"))).alias("sku_id"),
        F.when(F.expr(UNKNOWN_SKU), none("product_id")).otherwise(F.col("product_id")).alias("product_id"), "quantity",
        F.when(~F.expr(BLANK_PRICE), F.col("unit_price") + F.when(F.expr(DEARER), 1).otherwise(0))
        .cast("decimal(8,2)").alias("unit_price"), "total_price")


def _faulty(spark, sf):
    s = star(spark, sf)
    return faulty_fact(s.fact), s


@query("audit_row_counts_against_source", "C", with_star("""
SELECT table_name, expected, actual, CASE WHEN expected = actual THEN 'PASS' ELSE 'FAIL' END AS status FROM (
  SELECT 'fact_sales' AS table_name, (SELECT COUNT(*) FROM lineitem) AS expected, (SELECT COUNT(*) FROM faulty) AS actual
  UNION ALL SELECT 'dim_date', (SELECT COUNT(DISTINCT CAST(o_orderdate AS DATE)) FROM orders), (SELECT COUNT(*) FROM dim_date)
  UNION ALL SELECT 'dim_product', (SELECT COUNT(DISTINCT p_brand) FROM part), (SELECT COUNT(*) FROM dim_product)) c""", _FAULTY))
def _counts(spark, sf):
    fact, s = _faulty(spark, sf)
    source = {"fact_sales": read_table(spark, sf, "lineitem"),
              "dim_date": read_table(spark, sf, "orders").select(F.col("o_orderdate").cast("date")).distinct(),
              "dim_product": read_table(spark, sf, "part").select("p_brand").distinct()}
    return audit.audit_counts_against({"fact_sales": fact, "dim_date": s.dim_date, "dim_product": s.dim_product}, source)


@query("audit_nulls_planted", "C", with_star(" UNION ALL ".join(
    f"SELECT 'fact_sales' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count, "
    f"CASE WHEN COUNT(*) = COUNT({c}) THEN 'PASS' ELSE 'FAIL' END AS status FROM faulty"
    for t, c in NULL_CHECKS if t == "fact_sales"), _FAULTY))
def _nulls(spark, sf):
    return audit.audit_nulls({"fact_sales": _faulty(spark, sf)[0]}, [x for x in NULL_CHECKS if x[0] == "fact_sales"])


@query("audit_orphans_planted", "C", with_star(" UNION ALL ".join(
    f"SELECT '{name}' AS check_name, SUM(n)::BIGINT AS orphaned_rows, CASE WHEN SUM(n) = 0 THEN 'PASS' ELSE 'FAIL' END AS status "
    f"FROM (SELECT CASE WHEN {key} IN (SELECT {key} FROM {dim}) THEN 0 ELSE 1 END AS n FROM faulty) x"
    for name, dim, key in FK_CHECKS), _FAULTY))
def _orphans(spark, sf):
    fact, s = _faulty(spark, sf)
    return audit.audit_orphans(fact, [(n, s.tables()[d], k) for n, d, k in FK_CHECKS])


@query("audit_zero_days_planted", "C", with_star("""
SELECT d.date_id, d.day_name, CAST(0 AS BIGINT) AS order_count
FROM dim_date d LEFT JOIN (SELECT date_id, COUNT(*) AS n FROM faulty GROUP BY date_id) f ON f.date_id = d.date_id
WHERE n IS NULL""", _FAULTY))
def _zero_days(spark, sf):
    fact, s = _faulty(spark, sf)
    return audit.zero_days(s.dim_date, fact)


@query("audit_price_consistency_planted", "C", with_star("""
SELECT sku_id, len(prices) AS distinct_prices, CAST(list_min(prices) AS DOUBLE) AS min_price, CAST(list_max(prices) AS DOUBLE) AS max_price
FROM (SELECT sku_id, list(DISTINCT unit_price) FILTER (WHERE unit_price IS NOT NULL) AS prices FROM faulty GROUP BY sku_id) p
WHERE len(prices) > 1""", _FAULTY))
def _prices(spark, sf):
    return audit.price_conflicts(_faulty(spark, sf)[0], "sku_id", "unit_price")


@query("audit_menu_coverage_planted", "C", with_star("""
SELECT k.sku_id, p.name, k.size, CAST(0 AS BIGINT) AS times_ordered
FROM dim_sku k JOIN dim_product p ON p.product_id = k.product_id
LEFT JOIN (SELECT DISTINCT sku_id AS sold FROM faulty) f ON f.sold = k.sku_id WHERE sold IS NULL""", _FAULTY))
def _coverage(spark, sf):
    fact, s = _faulty(spark, sf)
    return audit.unsold_skus(s.dim_sku, s.dim_product, fact)


@query("audit_duplicates_planted", "C", with_star("""
SELECT SUM(n)::BIGINT AS total_rows, COUNT(*) AS unique_ids, (SUM(n) - COUNT(*))::BIGINT AS duplicates,
       CASE WHEN SUM(n) = COUNT(*) THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT order_id, line_no, COUNT(*) AS n FROM faulty GROUP BY order_id, line_no) k""", _FAULTY))
def _duplicates(spark, sf):
    return audit.duplicate_keys(_faulty(spark, sf)[0], ["order_id", "line_no"])


# Opening month of the test tables: few units a product, so some fall below the limit.
_OPENING = "date_id < DATE '1992-02-01'"


@query("low_sellers_opening", "D", with_star(f"""
SELECT d.product_id, d.name, d.category, COALESCE(t.units, 0) AS total_quantity, COALESCE(t.revenue, 0.0) AS total_revenue
FROM dim_product d LEFT JOIN (
  SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS units, CAST(SUM(total_price) AS DOUBLE) AS revenue
  FROM fact_sales WHERE {_OPENING} GROUP BY product_id) t USING (product_id)
WHERE COALESCE(t.units, 0) < 500"""))
def _low_opening(spark, sf):
    s = star(spark, sf)
    return sales.low_sellers(s.dim_product, s.fact.where(_OPENING), 500)


@query("sales_by_hour_labelled", "D", with_star("""
SELECT printf('%02d:00', hour) AS hour_label, COUNT(DISTINCT order_id) AS total_orders
FROM fact_sales JOIN dim_time USING (time_id) WHERE hour >= 11 GROUP BY hour"""))
def _labelled(spark, sf):
    s = star(spark, sf)
    return sales.label_hours(sales.sales_by_hour(s.fact, s.dim_time)).where("hour >= 11").select("hour_label", "total_orders")


# P6: the chart counts only a strictly positive divergence as above; the report counts zero too.
@query("rank_divergence_strict", "D", with_star("""
SELECT name, CAST(volume_rank - revenue_rank AS INT) AS rank_divergence,
       CASE WHEN volume_rank > revenue_rank THEN 'earns above volume weight' ELSE 'sells above revenue weight' END AS direction
FROM (SELECT d.name, RANK() OVER (ORDER BY t.units DESC) AS volume_rank, RANK() OVER (ORDER BY t.revenue DESC) AS revenue_rank
      FROM dim_product d JOIN (SELECT product_id, SUM(quantity) AS units, SUM(total_price) AS revenue FROM fact_sales
                               GROUP BY product_id) t USING (product_id)) r"""))
def _divergence(spark, sf):
    s = star(spark, sf)
    return (sales.rank_divergence(sales.menu_ranking(s.fact, s.dim_product), zero_is_above=False)
            .select("name", "rank_divergence", "direction"))


# P8: the text asks for both signals, the code takes either; this is both.
@query("cannibalisation_candidates_both", "F", with_star("""
SELECT category, name_a, name_b, w.lift, c.correlation
FROM corr c JOIN within w USING (category, name_a, name_b) WHERE c.correlation < 0.05 AND w.lift < 1.0""",
                                                        _LIFT_CTES + "," + _WITHIN + "," + _DAILY + "," + _CORR))
def _both(spark, sf):
    items, s = _items(spark, sf)
    within = basket.within_category_lift(basket.pair_lift(items, s.dim_product))
    corr = basket.daily_correlation(basket.daily_units(s.fact, s.dim_product), s.dim_product)
    return basket.candidates(within, corr, mode="all")
