"""DuckDB oracle text for every registered query.

Each oracle inlines the star-schema binding as CTEs over the raw views
(``part``, ``orders``, ``lineitem``), then states the operator in plain
SQL. Ratios that the reference rounds are rounded from exact integers
(cents, counts) with the same rule as ``functions.scalar.exact_round``, so
both engines print the same digits.
"""

from __future__ import annotations

# Binding CTEs (fixed; must mirror sources/testdata.py).
_SIZE = ("CASE WHEN p_size<=10 THEN 'S' WHEN p_size<=20 THEN 'M' WHEN p_size<=30 THEN 'L' "
         "WHEN p_size<=40 THEN 'XL' ELSE 'XXL' END")

STAR_CTES = f"""
psize AS (SELECT p_partkey, p_brand AS product_id, {_SIZE} AS size, p_retailprice FROM part),
dim_sku AS (
  SELECT concat(product_id,'_',size) AS sku_id, product_id, size,
         CAST(min(CAST(p_retailprice AS DECIMAL(8,2))) *
              CASE size WHEN 'S' THEN CAST(0.80 AS DECIMAL(4,2)) WHEN 'M' THEN CAST(1.00 AS DECIMAL(4,2))
                        WHEN 'L' THEN CAST(1.25 AS DECIMAL(4,2)) WHEN 'XL' THEN CAST(1.60 AS DECIMAL(4,2))
                        ELSE CAST(2.20 AS DECIMAL(4,2)) END AS DECIMAL(8,2)) AS price
  FROM psize GROUP BY product_id, size),
dim_product AS (
  SELECT product_id, concat('The ',product_id) AS name,
         concat('cat_', CAST(CAST(substr(product_id,7) AS INT) % 4 AS VARCHAR)) AS category
  FROM (SELECT DISTINCT p_brand AS product_id FROM part) p),
fact_sales AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_no, CAST(o.o_orderdate AS DATE) AS date_id,
         CAST(32400 + (o.o_orderkey*7919) % 50400 AS INT) AS time_id,
         k.sku_id, k.product_id, CAST(l.l_quantity AS INT) AS quantity, k.price AS unit_price,
         CAST(CAST(l.l_quantity AS INT) * k.price AS DECIMAL(12,2)) AS total_price
  FROM lineitem l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN psize p ON l.l_partkey = p.p_partkey
  LEFT JOIN dim_sku k ON k.product_id = p.product_id AND k.size = p.size),
dim_time AS (
  SELECT time_id, CAST(floor(time_id/3600) AS INT) AS hour,
         CAST(floor((time_id % 3600)/60) AS INT) AS minute,
         CASE WHEN time_id < 32400 THEN 'Late Night' WHEN time_id < 39600 THEN 'Morning'
              WHEN time_id < 54000 THEN 'Lunch' WHEN time_id < 64800 THEN 'Afternoon'
              WHEN time_id < 79200 THEN 'Dinner' ELSE 'Late Night' END AS meal_period
  FROM (SELECT DISTINCT CAST(32400 + (o_orderkey*7919) % 50400 AS INT) AS time_id FROM orders) t),
dim_date AS (
  SELECT date_id, CAST(year(date_id) AS INT) AS year, CAST(quarter(date_id) AS INT) AS quarter,
         CAST(month(date_id) AS INT) AS month, monthname(date_id) AS month_name,
         CAST(weekofyear(date_id) AS INT) AS week, CAST(day(date_id) AS INT) AS day_of_month,
         CAST(isodow(date_id) AS INT) AS day_of_week, dayname(date_id) AS day_name,
         CAST(CASE WHEN isodow(date_id) >= 6 THEN 1 ELSE 0 END AS INT) AS is_weekend
  FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date_id FROM orders) t)
"""


def with_star(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with the binding CTEs (plus optional extra CTEs)."""
    ctes = STAR_CTES.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return f"WITH {ctes}\n{body.strip()}"


def xround(num: str, den: str, scale: int = 2, mode: str = "half_up") -> str:
    """SQL twin of ``functions.scalar.exact_round`` (integer arithmetic)."""
    raw = f"CAST({num} AS HUGEINT)"
    n = f"(abs({raw}) * {10 ** scale})"
    d = f"CAST({den} AS HUGEINT)"
    q = f"({n} // {d})"
    r = f"({n} % {d})"
    if mode == "half_up":
        qq = f"(CASE WHEN 2*{r} >= {d} THEN {q}+1 ELSE {q} END)"
    else:
        qq = (f"(CASE WHEN 2*{r} > {d} THEN {q}+1 WHEN 2*{r} = {d} THEN {q} + ({q} % 2) "
              f"ELSE {q} END)")
    qq = f"(CASE WHEN {raw} < 0 THEN -{qq} ELSE {qq} END)"
    return f"(CASE WHEN {d} = 0 THEN NULL ELSE CAST({qq} AS DOUBLE) / CAST({10 ** scale} AS DOUBLE) END)"


def cents(expr: str) -> str:
    return f"CAST(({expr}) * 100 AS HUGEINT)"


def share(part: str, total: str, scale: int = 1) -> str:
    return xround(f"({part}) * 100", total, scale)
