"""Registered queries for time series, gap filling and decomposition."""

from __future__ import annotations

from tallystar.operators import series, stl
from tallystar.plans.oracle_sql import cents, with_star, xround
from tallystar.plans.registry import query
from tallystar.sources.testdata import star_from_dir as star

ORD = "COUNT(DISTINCT f.order_id) AS total_orders"
UNITS = "CAST(SUM(f.quantity) AS BIGINT) AS total_units"
REV = "CAST(SUM(f.total_price) AS DOUBLE) AS total_revenue"
AOV = xround(cents("SUM(f.total_price)"), "COUNT(DISTINCT f.order_id) * 100") + " AS avg_order_value"

# Daily distinct orders, its calendar, and the weekday-median fill.
SERIES_CTES = """
ds AS (SELECT date_id, COUNT(DISTINCT order_id) AS total_orders FROM fact_sales GROUP BY date_id),
cal AS (SELECT CAST(unnest(generate_series(MIN(date_id), MAX(date_id), INTERVAL 1 DAY)) AS DATE) AS date_id
        FROM ds),
fullcal AS (SELECT c.date_id, s.total_orders, dayname(c.date_id) AS dow,
                   s.total_orders IS NULL AS is_imputed
            FROM cal c LEFT JOIN ds s ON c.date_id = s.date_id),
med AS (SELECT dow, median(total_orders) AS m FROM fullcal WHERE NOT is_imputed GROUP BY dow),
filled AS (SELECT f.date_id, CAST(COALESCE(f.total_orders, round_even(m.m, 0)) AS BIGINT) AS total_orders,
                  f.is_imputed
           FROM fullcal f LEFT JOIN med m ON f.dow = m.dow)"""

DECOMP_CTES = SERIES_CTES + """,
b AS (SELECT date_id, CAST(total_orders AS DOUBLE) AS observed,
             CAST(datediff('day', MIN(date_id) OVER (), date_id) % 7 AS INT) AS pos FROM filled),
tr AS (SELECT *, AVG(observed) OVER (ORDER BY date_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS trend
       FROM b),
pm AS (SELECT pos, AVG(observed - trend) AS s FROM tr GROUP BY pos),
pc AS (SELECT pos, s - AVG(s) OVER () AS s FROM pm),
decomp AS (SELECT tr.date_id, tr.observed, round(tr.trend, 4) AS trend, round(pc.s, 4) AS seasonal,
                  round(tr.observed - tr.trend - pc.s, 4) AS remainder
           FROM tr JOIN pc ON tr.pos = pc.pos)"""


def _filled(spark, sf):
    return series.gap_fill(series.daily_orders(star(spark, sf).fact))


def _decomp(spark, sf):
    return series.decompose(_filled(spark, sf))


@query("daily_series", "G", with_star(f"""
SELECT f.date_id, d.day_of_week, d.day_name, d.is_weekend, {ORD}, {UNITS}, {REV}, {AOV}
FROM fact_sales f JOIN dim_date d ON f.date_id = d.date_id
GROUP BY f.date_id, d.day_of_week, d.day_name, d.is_weekend"""))
def _daily(spark, sf):
    s = star(spark, sf)
    return series.daily_series(s.fact, s.dim_date)


@query("weekly_series", "G", with_star(f"""
SELECT d.year, d.week, MIN(f.date_id) AS week_start_date, {ORD}, {UNITS}, {REV}, {AOV}
FROM fact_sales f JOIN dim_date d ON f.date_id = d.date_id GROUP BY d.year, d.week"""))
def _weekly(spark, sf):
    s = star(spark, sf)
    return series.weekly_series(s.fact, s.dim_date)


@query("weekly_series_iso", "G", with_star(f"""
SELECT CAST(isoyear(f.date_id) AS INT) AS iso_year, d.week, MIN(f.date_id) AS week_start_date,
       {ORD}, {UNITS}, {REV}, {AOV}
FROM fact_sales f JOIN dim_date d ON f.date_id = d.date_id GROUP BY isoyear(f.date_id), d.week"""))
def _weekly_iso(spark, sf):
    s = star(spark, sf)
    return series.weekly_series(s.fact, s.dim_date, iso_year=True)


@query("monthly_series", "G", with_star(f"""
SELECT d.year, d.month, d.month_name, {ORD}, {UNITS}, {REV}, {AOV}
FROM fact_sales f JOIN dim_date d ON f.date_id = d.date_id GROUP BY d.year, d.month, d.month_name"""))
def _monthly(spark, sf):
    s = star(spark, sf)
    return series.monthly_series(s.fact, s.dim_date)


@query("hourly_series", "G", with_star(f"""
SELECT f.date_id, t.hour, t.meal_period, {ORD}, {UNITS}, {REV}
FROM fact_sales f JOIN dim_time t ON f.time_id = t.time_id GROUP BY f.date_id, t.hour, t.meal_period"""))
def _hourly(spark, sf):
    s = star(spark, sf)
    return series.hourly_series(s.fact, s.dim_time)


@query("daily_by_period", "G", with_star("""
SELECT f.date_id, t.meal_period, COUNT(DISTINCT f.order_id) AS daily_orders,
       CAST(SUM(f.total_price) AS DOUBLE) AS daily_revenue
FROM fact_sales f JOIN dim_time t ON f.time_id = t.time_id
WHERE t.meal_period <> 'Morning' GROUP BY f.date_id, t.meal_period"""))
def _daily_by_period(spark, sf):
    s = star(spark, sf)
    return series.daily_by_period(s.fact, s.dim_time)


@query("daily_by_period_weekday", "G", with_star("""
SELECT f.date_id, d.day_name, t.meal_period, COUNT(DISTINCT f.order_id) AS daily_orders,
       CAST(SUM(f.total_price) AS DOUBLE) AS daily_revenue
FROM fact_sales f JOIN dim_time t ON f.time_id = t.time_id JOIN dim_date d ON f.date_id = d.date_id
WHERE t.meal_period <> 'Morning' GROUP BY f.date_id, d.day_name, t.meal_period"""))
def _daily_by_period_weekday(spark, sf):
    s = star(spark, sf)
    return series.daily_by_period(s.fact, s.dim_time, s.dim_date)


@query("daily_by_weekday", "G", with_star("""
SELECT f.date_id, d.day_name, d.day_of_week, COUNT(DISTINCT f.order_id) AS daily_orders,
       CAST(SUM(f.total_price) AS DOUBLE) AS daily_revenue
FROM fact_sales f JOIN dim_date d ON f.date_id = d.date_id GROUP BY f.date_id, d.day_name, d.day_of_week"""))
def _daily_by_weekday(spark, sf):
    s = star(spark, sf)
    return series.daily_by_weekday(s.fact, s.dim_date)


@query("missing_days", "G", with_star("""
SELECT c.date_id FROM cal c ANTI JOIN ds s ON c.date_id = s.date_id""", SERIES_CTES))
def _missing(spark, sf):
    return series.missing_days(series.daily_orders(star(spark, sf).fact))


@query("gap_fill_dow_median", "G", with_star("SELECT * FROM filled", SERIES_CTES))
def _fill_median(spark, sf):
    return _filled(spark, sf)


@query("gap_fill_null", "G", with_star("SELECT date_id, total_orders FROM fullcal", SERIES_CTES))
def _fill_null(spark, sf):
    return series.gap_fill(series.daily_orders(star(spark, sf).fact), how="null")


@query("decompose", "G", with_star("SELECT * FROM decomp", DECOMP_CTES))
def _decompose(spark, sf):
    return _decomp(spark, sf)


def _robust_round(n: int, before: str) -> str:
    """One weighted round in SQL: weights from the remainders of ``before``,
    then trend, seasonal and remainder (``rem{n}``)."""
    span = "OVER (ORDER BY date_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"
    return f""",
w{n} AS (SELECT r.date_id, r.observed, r.pos,
                CASE WHEN h <= 0 THEN 1.0 WHEN abs(rem) < h
                     THEN (1 - (abs(rem)/h)*(abs(rem)/h)) * (1 - (abs(rem)/h)*(abs(rem)/h)) ELSE 0.0 END AS w
         FROM {before} r, (SELECT 6.0 * median(abs(rem)) AS h FROM {before}) m),
t{n} AS (SELECT *, CASE WHEN SUM(w) {span} > 0 THEN SUM(w * observed) {span} / SUM(w) {span}
                        ELSE AVG(observed) {span} END AS trend FROM w{n}),
s{n} AS (SELECT pos, CASE WHEN SUM(w) > 0 THEN SUM(w * (observed - trend)) / SUM(w)
                          ELSE AVG(observed - trend) END AS s FROM t{n} GROUP BY pos),
c{n} AS (SELECT pos, s - AVG(s) OVER () AS s FROM s{n}),
rem{n} AS (SELECT date_id, observed, t.pos, trend, s AS seasonal, observed - trend - s AS rem
           FROM t{n} t JOIN c{n} c ON t.pos = c.pos)"""


ROBUST_CTES = (DECOMP_CTES + """,
rem0 AS (SELECT tr.date_id, tr.observed, tr.pos, tr.observed - tr.trend - pc.s AS rem
         FROM tr JOIN pc ON tr.pos = pc.pos)""" + _robust_round(1, "rem0") + _robust_round(2, "rem1"))


@query("decompose_robust", "G", with_star("""
SELECT date_id, observed, round(trend, 4) AS trend, round(seasonal, 4) AS seasonal,
       round(rem, 4) AS remainder FROM rem2""", ROBUST_CTES))
def _decompose_robust(spark, sf):
    return series.decompose(_filled(spark, sf), robust_iters=2)


@query("trend_trim", "G", with_star("""
SELECT date_id, observed,
       CASE WHEN date_id > MAX(date_id) OVER () - INTERVAL 21 DAY THEN NULL ELSE trend END AS trend,
       seasonal, remainder
FROM decomp""", DECOMP_CTES))
def _trend_trim(spark, sf):
    return series.trim_tail(_decomp(spark, sf), "trend", 21)


_LONG = """
SELECT date_id, 'Observed' AS component, observed AS value FROM trimmed
UNION ALL SELECT date_id, 'Trend', trend FROM trimmed
UNION ALL SELECT date_id, 'Seasonal', seasonal FROM trimmed
UNION ALL SELECT date_id, 'Remainder', remainder FROM trimmed"""
_TRIMMED = """,
trimmed AS (SELECT date_id, observed,
                   CASE WHEN date_id > MAX(date_id) OVER () - INTERVAL 21 DAY THEN NULL ELSE trend END AS trend,
                   seasonal, remainder FROM decomp)"""


@query("decompose_long", "G", with_star(_LONG, DECOMP_CTES + _TRIMMED))
def _decompose_long(spark, sf):
    return series.decompose_long(series.trim_tail(_decomp(spark, sf), "trend", 21))


@query("decompose_summary", "G", with_star("""
SELECT component, round(MIN(value), 4) AS min, round(quantile_cont(value, 0.25), 4) AS q1,
       round(quantile_cont(value, 0.5), 4) AS median, round(AVG(value), 4) AS mean,
       round(quantile_cont(value, 0.75), 4) AS q3, round(MAX(value), 4) AS max
FROM (SELECT date_id, 'observed' AS component, observed AS value FROM decomp
      UNION ALL SELECT date_id, 'trend', trend FROM decomp
      UNION ALL SELECT date_id, 'seasonal', seasonal FROM decomp
      UNION ALL SELECT date_id, 'remainder', remainder FROM decomp) l
GROUP BY component""", DECOMP_CTES))
def _decompose_summary(spark, sf):
    return series.decompose_summary(_decomp(spark, sf))


# --- loess decomposition --------------------------------------------------------

def _stl_ctes(rounds: int, robust: bool = True, window: int = 11, period: int = 7) -> str:
    """The rounds of ``operators.stl`` unrolled; the local lines read each
    day's window by a join on the day number."""
    out = SERIES_CTES + """,
y0 AS MATERIALIZED (SELECT date_id, CAST(total_orders AS DOUBLE) AS y, ROW_NUMBER() OVER (ORDER BY date_id) - 1 AS i,
                           COUNT(*) OVER () AS n, 1.0::DOUBLE AS w, 0.0::DOUBLE AS t FROM filled)"""
    for k in range(1, rounds + 1):
        near = f"(greatest(least(a.i - {window // 2}, a.n - {window}), 0))"
        weight = "1.0::DOUBLE" if k == rounds or not robust else """CASE WHEN r <= 0.001 * h THEN 1.0
                WHEN r <= 0.999 * h THEN (1 - (r/h)*(r/h)) * (1 - (r/h)*(r/h)) ELSE 0.0 END"""
        out += f""",
c{k} AS (SELECT i % {period} AS p, CASE WHEN SUM(w) > 0 THEN SUM(w * (y - t)) / SUM(w) ELSE AVG(y - t) END AS c
         FROM y{k - 1} GROUP BY i % {period}),
s{k} AS MATERIALIZED (SELECT x.date_id, x.y, x.i, x.n, x.w, x.t, c - (SELECT AVG(c) FROM c{k}) AS s, y - c + (SELECT AVG(c) FROM c{k}) AS z
         FROM y{k - 1} x JOIN c{k} ON i % {period} = p),
l{k} AS (SELECT a.i, b.i AS j, b.z, b.w, greatest(a.i - {near}, least({near} + {window - 1}, a.n - 1) - a.i)::DOUBLE AS h,
                abs(b.i - a.i)::DOUBLE AS d, (b.i - a.i)::DOUBLE AS x
         FROM s{k} a JOIN s{k} b ON b.i BETWEEN {near} AND least({near} + {window - 1}, a.n - 1)),
v{k} AS (SELECT i, z, x, w * CASE WHEN d > 0.999 * h THEN 0.0 WHEN d <= 0.001 * h THEN 1.0
                ELSE (1 - (d/h)*(d/h)*(d/h)) * (1 - (d/h)*(d/h)*(d/h)) * (1 - (d/h)*(d/h)*(d/h)) END AS w FROM l{k}),
m{k} AS (SELECT i, SUM(w) AS s0, SUM(w*x) / SUM(w) AS mean, SUM(w*x*x) / SUM(w) AS sq, SUM(w*z) / SUM(w) AS level,
                SUM(w*x*z) / SUM(w) AS xz FROM v{k} GROUP BY i),
t{k} AS MATERIALIZED (
  SELECT q.date_id, q.y, q.i, q.n, q.s, CASE WHEN s0 > 0 THEN CASE WHEN sqrt(greatest(sq - mean*mean, 0.0)) > 0.001 * (q.n - 1)
              THEN level - mean / (sq - mean*mean) * (xz - mean*level) ELSE level END ELSE q.z END AS t
  FROM s{k} q JOIN m{k} ON q.i = m{k}.i),
h{k} AS (SELECT 6.0 * median(round(abs(y - s - t), 9)) AS h FROM t{k}),
y{k} AS MATERIALIZED (SELECT date_id, y, i, n, {weight} AS w, t, s FROM (SELECT t{k}.*, round(abs(y - s - t), 9) AS r, h FROM t{k}, h{k}) u)"""
    return out + f""",
stl AS (SELECT date_id, y AS observed, round(round(t, 9), 4) + 0.0 AS trend, round(round(s, 9), 4) + 0.0 AS seasonal,
               round(round(y - t - s, 9), 4) + 0.0 AS remainder
        FROM y{rounds}),
trimmed AS (SELECT date_id, observed, CASE WHEN date_id > MAX(date_id) OVER () - INTERVAL 21 DAY THEN NULL ELSE trend END AS trend,
                   seasonal, remainder FROM stl)"""


@query("stl_decompose", "G", with_star("SELECT * FROM stl", _stl_ctes(stl.INNER_ROUNDS, robust=False)))
def _stl(spark, sf):
    return stl.stl(_filled(spark, sf))


@query("stl_decompose_robust", "G", with_star("SELECT * FROM stl", _stl_ctes(stl.ROBUST_ROUNDS + 1)))
def _stl_robust(spark, sf):
    return stl.stl(_filled(spark, sf), robust=True)


@query("stl_trend_trim", "G", with_star("SELECT * FROM trimmed", _stl_ctes(stl.ROBUST_ROUNDS + 1)))
def _stl_trim(spark, sf):
    return series.trim_tail(stl.stl(_filled(spark, sf), robust=True), "trend", 21)


@query("stl_long", "G", with_star(_LONG, _stl_ctes(stl.ROBUST_ROUNDS + 1)))
def _stl_long(spark, sf):
    return series.decompose_long(series.trim_tail(stl.stl(_filled(spark, sf), robust=True), "trend", 21))


@query("stl_summary", "G", with_star("""
SELECT component, round(MIN(value), 4) AS min, round(quantile_cont(value, 0.25), 4) AS q1,
       round(quantile_cont(value, 0.5), 4) AS median, round(AVG(value), 4) AS mean,
       round(quantile_cont(value, 0.75), 4) AS q3, round(MAX(value), 4) AS max
FROM (SELECT unnest(['observed', 'trend', 'seasonal', 'remainder']) AS component,
             unnest([observed, trend, seasonal, remainder]) AS value FROM stl) l GROUP BY component""",
                                  _stl_ctes(stl.ROBUST_ROUNDS + 1)))
def _stl_summary(spark, sf):
    return series.decompose_summary(stl.stl(_filled(spark, sf), robust=True))
