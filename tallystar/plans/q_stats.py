"""Registered queries for the rank tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystar.operators import series, stats
from tallystar.plans.registry import query
from tallystar.plans.oracle_sql import with_star
from tallystar.sources.testdata import star_from_dir as star

_DBP = """
dbp AS (SELECT f.date_id, d.day_name, t.meal_period, COUNT(DISTINCT f.order_id) AS daily_orders
        FROM fact_sales f JOIN dim_time t ON f.time_id = t.time_id JOIN dim_date d ON f.date_id = d.date_id
        WHERE t.meal_period <> 'Morning' GROUP BY f.date_id, d.day_name, t.meal_period)"""
_DOW = """
dow AS (SELECT f.date_id, d.day_name, COUNT(DISTINCT f.order_id) AS daily_orders
        FROM fact_sales f JOIN dim_date d ON f.date_id = d.date_id GROUP BY f.date_id, d.day_name)"""

# erfc for the odd-df tail: DuckDB has no erf, so the oracle uses the
# Chebyshev fit erfc(z) ~ t*exp(-z^2 + P(t)), t = 1/(1+z/2), |rel err| < 1.2e-7;
# p-values are compared to 5 significant digits.
_ERFC_COEF = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
              0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277]


def _erfc_sql(z: str) -> str:
    t = f"(1.0/(1.0 + 0.5*{z}))"
    poly = str(_ERFC_COEF[-1])
    for c in reversed(_ERFC_COEF[:-1]):
        poly = f"({c} + {t}*{poly})"
    return f"({t} * exp(-({z})*({z}) + {poly}))"


def kruskal_sql(source: str, value: str, group: str, test: str) -> str:
    half = "(statistic/2.0)"
    even = (f"(exp(-{half}) * (SELECT COALESCE(SUM(exp(i*ln({half}) - lgamma(i+1))), 0) "
            f"FROM range(0, CAST(df/2 AS BIGINT)) r(i)))")
    odd = (f"({_erfc_sql(f'sqrt({half})')} + exp(-{half}) * "
           f"(SELECT COALESCE(SUM(exp((i-0.5)*ln({half}) - lgamma(i+0.5))), 0) "
           f"FROM range(1, CAST((df-1)/2 AS BIGINT) + 1) r(i)))")
    x = test
    return f"""
d_{x} AS (SELECT {group} AS g, CAST({value} AS DOUBLE) AS v FROM {source}
      WHERE {group} IS NOT NULL AND {value} IS NOT NULL),
vc_{x} AS (SELECT v, CAST(COUNT(*) AS DOUBLE) AS t FROM d_{x} GROUP BY v),
rk_{x} AS (SELECT v, t, SUM(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                 - (t - 1.0)/2.0 AS rank FROM vc_{x}),
grp_{x} AS (SELECT d.g, CAST(COUNT(*) AS DOUBLE) AS n, SUM(rk.rank) AS rs
            FROM d_{x} d JOIN rk_{x} rk ON d.v = rk.v GROUP BY d.g),
st_{x} AS (SELECT SUM(n) AS "N", COUNT(*) AS k, SUM(rs*rs/n) AS s FROM grp_{x}),
ti_{x} AS (SELECT SUM(t*t*t - t) AS ties FROM vc_{x}),
h_{x} AS (SELECT round((12.0/("N"*("N"+1.0))*s - 3.0*("N"+1.0)) / (1.0 - ties/("N"*"N"*"N" - "N")), 6)
             AS statistic, CAST(k - 1 AS INT) AS df, CAST("N" AS BIGINT) AS n, CAST(k AS BIGINT) AS groups
      FROM st_{x}, ti_{x}),
p_{x} AS (SELECT '{test}' AS test, statistic, df, n, groups,
             CAST(printf('%.4e', CASE WHEN df % 2 = 0 THEN {even} ELSE {odd} END) AS DOUBLE) AS p_value
      FROM h_{x}),
res_{x} AS (SELECT *, p_value < 0.05 AS significant,
             CASE WHEN p_value < 0.05 THEN 'statistically significant difference'
                  ELSE 'no statistically significant difference' END AS verdict FROM p_{x})"""


_TESTS = {
    "kruskal_meal_period": ("dbp", "daily_orders", "meal_period", _DBP),
    "kruskal_weekday_by_period": ("dbp", "daily_orders", "day_name", _DBP),
    "kruskal_weekday": ("dow", "daily_orders", "day_name", _DOW),
}


def _one_sql(name: str) -> str:
    src, value, group, cte = _TESTS[name]
    return with_star(f"SELECT * FROM res_{name}", cte + "," + kruskal_sql(src, value, group, name))


def observations(spark, sf):
    """(test, group, value) of all three tests from one scan of the fact: orders
    per day and period, rolled up to the day. An order has one time of day, so
    a day's orders are the sum of its periods'."""
    s = star(spark, sf)
    daily = series.daily_by_period(s.fact, s.dim_time, s.dim_date, exclude=())
    day = daily.groupBy("date_id", "day_name").agg(
        F.collect_list(F.struct(F.col("meal_period").alias("p"), F.col("daily_orders").alias("n"))).alias("own"),
        F.sum("daily_orders").alias("n"))
    row = lambda test, group, n: F.struct(F.lit(test).alias("test"), group.alias("group"), n.alias("value"))
    kept = F.filter("own", lambda e: e["p"] != "Morning")
    each = F.concat(F.transform(kept, lambda e: row("kruskal_meal_period", e["p"], e["n"])),
                    F.transform(kept, lambda e: row("kruskal_weekday_by_period", F.col("day_name"), e["n"])),
                    F.array(row("kruskal_weekday", F.col("day_name"), F.col("n"))))
    return day.select(F.explode(each).alias("o")).select("o.*")


def _test(name: str):
    return lambda spark, sf: stats.kruskal_tests(observations(spark, sf).where(F.col("test") == name))


for _name in _TESTS:
    query(_name, "I", _one_sql(_name))(_test(_name))


def _all_sql(select: str) -> str:
    ctes = [_DBP, _DOW] + [kruskal_sql(src, v, g, name) for name, (src, v, g, _) in _TESTS.items()]
    body = " UNION ALL ".join(f"SELECT {select} FROM res_{name}" for name in _TESTS)
    return with_star(body, ",".join(ctes))


@query("chi2_p_value", "I", _all_sql("test, statistic, df, p_value"))
def _chi2(spark, sf):
    return stats.kruskal_tests(observations(spark, sf)).select("test", "statistic", "df", "p_value")


@query("significance_flag", "I", _all_sql("test, p_value, significant, verdict"))
def _significance(spark, sf):
    return stats.kruskal_tests(observations(spark, sf)).select("test", "p_value", "significant", "verdict")
