"""Registered queries for the forecast and staffing plan.

The plain names run the full model (``operators.demand``: changepoints, weekly
and yearly seasons, dated events, simulated interval); ``*_additive`` run the
closed-form model of ``operators.forecast``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tallystar.operators import demand, forecast, sales, series
from tallystar.plans.oracle_sql import with_star, xround
from tallystar.plans.registry import query
from tallystar.session import cut_lineage
from tallystar.sources.testdata import star_from_dir as star

HORIZON = 30
HOLDOUT = 14
Z90 = 1.6448536269514715   # normal quantile for a 90 % interval


def _rules_sql() -> str:
    rows = ", ".join(f"('{n.replace(chr(39), chr(39) * 2)}', '{k}', {m}, {d}, {lo}, {hi})"
                     for n, k, m, d, lo, hi in forecast.HOLIDAYS)
    return f"(VALUES {rows}) r(holiday, kind, m, d, lo, hi)"


FC_CTES = f"""
ds AS (SELECT date_id, COUNT(DISTINCT order_id) AS total_orders FROM fact_sales GROUP BY date_id),
cal AS (SELECT CAST(unnest(generate_series(MIN(date_id), MAX(date_id), INTERVAL 1 DAY)) AS DATE) AS date_id
        FROM ds),
ser AS (SELECT c.date_id, s.total_orders FROM cal c LEFT JOIN ds s ON c.date_id = s.date_id),
train AS (SELECT * FROM ser WHERE date_id <= (SELECT MAX(date_id) FROM ser) - INTERVAL {HOLDOUT} DAY),
yrs AS (SELECT unnest(generate_series(year(MIN(date_id)),
                                      year(MAX(date_id) + INTERVAL {HOLDOUT + HORIZON} DAY))) AS y FROM ser),
hd AS (SELECT holiday,
              CASE WHEN kind = 'thanksgiving'
                   THEN make_date(y, 11, 1) + CAST((4 - isodow(make_date(y, 11, 1)) + 7) % 7 + 21 + d AS INT)
                   ELSE make_date(y, m, d) END AS ds, lo, hi
       FROM yrs CROSS JOIN {_rules_sql()}),
hol_days AS (SELECT holiday, CAST(unnest(generate_series(ds + lo, ds + hi, INTERVAL 1 DAY)) AS DATE) AS date_id
             FROM hd),
obs AS (SELECT date_id, CAST(total_orders AS DOUBLE) AS yv FROM train WHERE total_orders IS NOT NULL),
org AS (SELECT MIN(date_id) AS origin FROM obs),
base AS (SELECT o.date_id, o.yv, CAST(datediff('day', g.origin, o.date_id) AS DOUBLE) AS t,
                dayname(o.date_id) AS day_name
         FROM obs o CROSS JOIN org g),
sums AS (SELECT CAST(COUNT(*) AS DOUBLE) AS n, SUM(t) AS st, SUM(yv) AS sy, SUM(t*t) AS stt,
                SUM(t*yv) AS sty FROM base),
tb AS (SELECT CASE WHEN n*stt - st*st <> 0 THEN (n*sty - st*sy) / (n*stt - st*st) ELSE 0.0 END AS b,
              n, st, sy FROM sums),
trend AS (SELECT (SELECT origin FROM org) AS origin, (sy - b*st)/n AS a, b FROM tb),
wk AS (SELECT x.day_name, (x.syk - tr.a*x.nk - tr.b*x.stk)/x.nk AS effect
       FROM (SELECT day_name, CAST(COUNT(*) AS DOUBLE) AS nk, SUM(t) AS stk, SUM(yv) AS syk
             FROM base GROUP BY day_name) x CROSS JOIN trend tr),
r1 AS (SELECT b.date_id, b.yv - tr.a - tr.b*b.t - COALESCE(w.effect, 0.0) AS r1
       FROM base b CROSS JOIN trend tr LEFT JOIN wk w ON b.day_name = w.day_name),
hol AS (SELECT h.holiday, round(AVG(r1.r1), 9) AS effect FROM r1 JOIN hol_days h ON r1.date_id = h.date_id
        GROUP BY h.holiday),
hsum AS (SELECT h.date_id, SUM(e.effect) AS h FROM hol_days h JOIN hol e ON h.holiday = e.holiday
         GROUP BY h.date_id),
sig AS (SELECT round(stddev_samp(r1.r1 - COALESCE(hs.h, 0.0)), 9) AS sigma
        FROM r1 LEFT JOIN hsum hs ON r1.date_id = hs.date_id),
frame AS (SELECT CAST(unnest(generate_series(MIN(date_id), MAX(date_id) + INTERVAL {HOLDOUT + HORIZON} DAY,
                                             INTERVAL 1 DAY)) AS DATE) AS date_id,
                 MAX(date_id) AS hi FROM train),
pred AS (SELECT f.date_id, dayname(f.date_id) AS day_name, f.date_id > f.hi AS is_future,
                tr.a + tr.b*CAST(datediff('day', tr.origin, f.date_id) AS DOUBLE) AS trend,
                COALESCE(w.effect, 0.0) AS weekly, COALESCE(hs.h, 0.0) AS holidays, s.sigma
         FROM frame f CROSS JOIN trend tr CROSS JOIN sig s
         LEFT JOIN wk w ON dayname(f.date_id) = w.day_name
         LEFT JOIN hsum hs ON f.date_id = hs.date_id),
yh AS (SELECT *, trend + weekly + holidays AS yhat,
              trend + weekly + holidays - {Z90}*sigma AS yhat_lower,
              trend + weekly + holidays + {Z90}*sigma AS yhat_upper FROM pred),
fc AS (SELECT date_id, day_name,
              CAST(round_even(yhat*10000.0, 0) AS BIGINT) AS yhat_e4,
              CAST(round_even(yhat_lower*10000.0, 0) AS BIGINT) AS lower_e4,
              CAST(round_even(yhat_upper*10000.0, 0) AS BIGINT) AS upper_e4,
              CAST(round_even(trend*10000.0, 0) AS BIGINT) AS trend_e4,
              CAST(round_even(weekly*10000.0, 0) AS BIGINT) AS weekly_e4,
              CAST(round_even(holidays*10000.0, 0) AS BIGINT) AS holidays_e4
       FROM yh WHERE date_id > (SELECT MAX(date_id) FROM ser)),
plan AS (SELECT date_id, day_name, CAST(yhat_e4 AS DOUBLE) / 10000.0 AS yhat, CAST(lower_e4 AS DOUBLE) / 10000.0 AS yhat_lower,
                {xround("greatest(upper_e4, 0)", "10000", 0, "half_even")} AS yhat_upper, upper_e4, yhat_e4,
                lower_e4
         FROM fc),
plan2 AS (SELECT *, {xround("CAST(yhat_upper AS BIGINT) * 95000", "1000000", 0, "half_even")}
                      AS peak_hour_orders FROM plan)"""


def _pipeline(spark, sf, params: bool = False):
    fact = star(spark, sf).fact
    # The daily series feeds every branch of the model. Column pruning makes
    # the branches differ, so Spark would not reuse one exchange for all of
    # them; a checkpoint keeps it at one scan of the fact.
    ser = cut_lineage(series.gap_fill(series.daily_orders(fact), how="null"))
    train = forecast.training_window(ser, HOLDOUT)
    hol = forecast.holiday_calendar(forecast.holiday_bounds(ser, HOLDOUT + HORIZON))
    frame = forecast.future_frame(train, HOLDOUT + HORIZON, value="total_orders")
    model = forecast.fit(frame, hol, value="total_orders", materialize=params)
    return ser, train, hol, model, frame, forecast.predict(model)


@query("training_window", "H", with_star("SELECT date_id, total_orders FROM train", FC_CTES))
def _training(spark, sf):
    return _pipeline(spark, sf)[1]


@query("holiday_features", "H", with_star("SELECT holiday, date_id FROM hol_days", FC_CTES))
def _holidays(spark, sf):
    return _pipeline(spark, sf)[2]


@query("forecast_fit_additive", "H", with_star("""
SELECT 'intercept' AS term, CAST(NULL AS VARCHAR) AS level, round(a, 6) AS estimate FROM trend
UNION ALL SELECT 'slope', NULL, round(b, 6) FROM trend
UNION ALL SELECT 'weekday', day_name, round(effect, 6) FROM wk
UNION ALL SELECT 'holiday', holiday, round(effect, 6) FROM hol
UNION ALL SELECT 'sigma', NULL, round(sigma, 6) FROM sig""", FC_CTES))
def _fit(spark, sf):
    return forecast.model_table(_pipeline(spark, sf, params=True)[3], keys=[])


@query("future_frame", "H", with_star("SELECT date_id, date_id > hi AS is_future FROM frame", FC_CTES))
def _future(spark, sf):
    return _pipeline(spark, sf)[4].select("date_id", "is_future")


def _fc(spark, sf):
    ser, _, _, _, _, pred = _pipeline(spark, sf)
    return forecast.forecast_rows(pred, ser)


@query("forecast_predict_additive", "H", with_star("""
SELECT date_id, day_name, CAST(yhat_e4 AS DOUBLE) / 10000.0 AS yhat, CAST(lower_e4 AS DOUBLE) / 10000.0 AS yhat_lower,
       CAST(upper_e4 AS DOUBLE) / 10000.0 AS yhat_upper FROM fc""", FC_CTES))
def _predict(spark, sf):
    return _fc(spark, sf).select("date_id", "day_name", "yhat", "yhat_lower", "yhat_upper")


@query("forecast_components_additive", "H", with_star("""
SELECT date_id, is_future,
       CAST(round_even(trend*10000.0, 0) AS DOUBLE) / 10000.0 AS trend,
       CAST(round_even(weekly*10000.0, 0) AS DOUBLE) / 10000.0 AS weekly,
       CAST(round_even(holidays*10000.0, 0) AS DOUBLE) / 10000.0 AS holidays,
       CAST(round_even(yhat*10000.0, 0) AS DOUBLE) / 10000.0 AS yhat
FROM yh""", FC_CTES))
def _components(spark, sf):
    # Every date of the forecast frame: training history and the future.
    return forecast.components(_pipeline(spark, sf)[5])


@query("staffing_plan_additive", "H", with_star("""
SELECT date_id, day_name, yhat, yhat_lower, yhat_upper, peak_hour_orders,
       CAST(ceil(peak_hour_orders / 7.0) AS INT) AS staff_needed FROM plan2""", FC_CTES))
def _staffing(spark, sf):
    return forecast.staffing(_fc(spark, sf))


@query("staffing_report_additive", "H", with_star(f"""
SELECT date_id AS date, day_name,
       {xround("yhat_e4", "1000", 0, "half_even")} / 10.0 AS forecast_orders,
       {xround("lower_e4", "1000", 0, "half_even")} / 10.0 AS forecast_lower,
       {xround("round_even(yhat_upper*10000.0, 0)", "1000", 0, "half_even")} / 10.0 AS forecast_upper,
       peak_hour_orders AS forecast_peak_hour_orders,
       CAST(ceil(peak_hour_orders / 7.0) AS INT) AS staff_needed
FROM plan2""", FC_CTES))
def _report(spark, sf):
    return forecast.report(forecast.staffing(_fc(spark, sf)))


@query("peak_hour_ratio", "H", with_star(f"""
SELECT hour AS peak_hour, total_orders AS peak_orders, all_orders,
       {xround("total_orders", "all_orders", 4)} AS peak_ratio
FROM (SELECT t.hour, COUNT(DISTINCT f.order_id) AS total_orders,
             SUM(COUNT(DISTINCT f.order_id)) OVER () AS all_orders,
             ROW_NUMBER() OVER (ORDER BY COUNT(DISTINCT f.order_id) DESC, t.hour) AS rn
      FROM fact_sales f JOIN dim_time t ON f.time_id = t.time_id GROUP BY t.hour) x
WHERE rn = 1"""))
def _peak(spark, sf):
    s = star(spark, sf)
    return forecast.peak_ratio(sales.sales_by_hour(s.fact, s.dim_time))


# --- full model ---------------------------------------------------------------

PATHS = 500
SEED = 0


def _demand_ctes(changepoints: int, paths: int = PATHS) -> str:
    """The ridge fit in SQL: design columns as lists, moments by a self join on
    the day, Gauss-Jordan elimination of [A | I | X'y] as a recursive CTE."""
    spec = demand.Spec(changepoints=changepoints)
    a, b, c, d = spec.sizes
    base = a + b + c + d
    low, high = 0.05, 0.95
    return FC_CTES + f""",
hn AS (SELECT COALESCE(list(DISTINCT h.holiday ORDER BY h.holiday), []) AS names
       FROM hol_days h JOIN obs o ON h.date_id = o.date_id),
hl AS (SELECT date_id, list(holiday) AS own FROM hol_days GROUP BY date_id),
sp AS (SELECT epoch(MIN(date_id)) / 86400.0 AS origin,
              greatest(datediff('day', MIN(date_id), MAX(date_id)), 1)::DOUBLE AS span FROM obs),
days AS (SELECT f.date_id, f.date_id > f.hi AS is_future, epoch(f.date_id) / 86400.0 AS e, COALESCE(hl.own, []) AS own
         FROM frame f LEFT JOIN hl ON f.date_id = hl.date_id),
dx AS MATERIALIZED (
  SELECT date_id, is_future, e,
         list_concat([1.0, (e - origin) / span],
                     list_transform(range(1, {changepoints} + 1),
                                    lambda j: greatest((e - origin) / span - {spec.changepoint_range} * j / {max(changepoints, 1)}.0, 0.0)),
                     flatten(list_transform(range(1, {spec.weekly_order + 1}),
                                            lambda k: [sin(2 * pi() * k * e / 7.0), cos(2 * pi() * k * e / 7.0)])),
                     flatten(list_transform(range(1, {spec.yearly_order + 1}),
                                            lambda k: [sin(2 * pi() * k * e / 365.25), cos(2 * pi() * k * e / 365.25)])),
                     list_transform(names, lambda n: len(list_filter(own, lambda o: o = n))::DOUBLE)) AS x
  FROM days, sp, hn),
ox AS (SELECT d.date_id, o.yv, d.x FROM dx d JOIN obs o ON d.date_id = o.date_id),
lx AS MATERIALIZED (SELECT date_id, yv, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM ox),
xx AS MATERIALIZED (SELECT p.i, q.i AS j, SUM(p.v * q.v) AS v FROM lx p JOIN lx q ON p.date_id = q.date_id GROUP BY p.i, q.i),
xy AS MATERIALIZED (SELECT i, SUM(v * yv) AS v FROM lx GROUP BY i),
pen AS (SELECT i, CASE WHEN i <= {a} THEN {spec.trend_penalty!r} WHEN i <= {a + b} THEN {spec.changepoint_penalty!r}
                       ELSE {spec.season_penalty!r} END::DOUBLE AS v FROM xy),
m0 AS (SELECT list(row ORDER BY i) AS m, COUNT(*) AS p
       FROM (SELECT x.i, list_concat(list(x.v + CASE WHEN x.i = x.j THEN pen.v ELSE 0.0 END ORDER BY x.j),
                                     list(CASE WHEN x.i = x.j THEN 1.0::DOUBLE ELSE 0.0 END ORDER BY x.j),
                                     [any_value(xy.v)]) AS row
             FROM xx x JOIN pen ON x.i = pen.i JOIN xy ON x.i = xy.i GROUP BY x.i) r),
gj AS (SELECT 0 AS k, m, p FROM m0
       UNION ALL
       SELECT k + 1, list_transform(m, lambda r, i: CASE WHEN i = k + 1
                         THEN list_transform(r, lambda v: v / r[k + 1])
                         ELSE list_transform(r, lambda v, j: v - r[k + 1] * m[k + 1][j] / m[k + 1][k + 1]) END), p
       FROM gj WHERE k < p),
sol AS MATERIALIZED (SELECT list_transform(m, lambda r: r[2 * p + 1]) AS beta,
                            list_transform(m, lambda r, i: r[p + i]) AS inv, p
                     FROM gj WHERE k = p),
fr AS (SELECT any_value(sol.p) - SUM(pen.v * sol.inv[pen.i]) AS freedom FROM pen, sol),
rs AS (SELECT SUM(r * r) AS rss, COUNT(*) AS n
       FROM (SELECT ox.yv - list_dot_product(ox.x, sol.beta) AS r FROM ox, sol) q),
sg AS MATERIALIZED (SELECT sqrt(rss / greatest(n - freedom, 1.0)) AS sigma, freedom FROM rs, fr),
parts AS MATERIALIZED (
  SELECT date_id, is_future, e, origin, span, sigma,
         list_dot_product(x[1:{a + b}], beta[1:{a + b}]) AS trend,
         list_dot_product(x[{a + b + 1}:{a + b + c}], beta[{a + b + 1}:{a + b + c}]) AS weekly,
         list_dot_product(x[{a + b + c + 1}:{base}], beta[{a + b + c + 1}:{base}]) AS yearly,
         COALESCE(list_sum(list_transform(range({base + 1}, p + 1), lambda i: x[i] * beta[i])), 0.0) AS holidays,
         {f"list_avg(list_transform(beta[{a + 1}:{a + b}], lambda v: abs(v)))" if b else "0.0"} AS size,
         least(1.0, {b} / span) AS rate
  FROM dx, sp, sol, sg),
sim AS (SELECT date_id, path, e - origin - span AS ahead, trend + weekly + yearly + holidays AS yhat, span, sigma, size, rate,
               md5(concat_ws('|', '{SEED}', '0', path::VARCHAR, e::BIGINT::VARCHAR)) AS h
        FROM parts, range(0, {paths}) r(path) WHERE is_future),
dr AS (SELECT *, (('0x' || substr(h, 1, 8))::BIGINT + 0.5) / 4294967296.0 AS u0, (('0x' || substr(h, 9, 8))::BIGINT + 0.5) / 4294967296.0 AS u1,
              (('0x' || substr(h, 17, 8))::BIGINT + 0.5) / 4294967296.0 AS u2, (('0x' || substr(h, 25, 8))::BIGINT + 0.5) / 4294967296.0 AS u3
       FROM sim),
ch AS (SELECT *, CASE WHEN u0 < rate THEN -size * sign(u1 - 0.5) * ln(1.0 - 2.0 * abs(u1 - 0.5)) ELSE 0.0 END AS c FROM dr),
pa AS (SELECT date_id, yhat + (ahead * SUM(c) OVER w - SUM(c * ahead) OVER w) / span
                       + sigma * sqrt(-2.0 * ln(u2)) * cos(2 * pi() * u3) AS v
       FROM ch WINDOW w AS (PARTITION BY path ORDER BY date_id ROWS UNBOUNDED PRECEDING)),
qs AS (SELECT date_id, quantile_cont(v, {low}) AS lo, quantile_cont(v, {high}) AS hi FROM pa GROUP BY date_id),
full_fc AS MATERIALIZED (
  SELECT p.date_id, dayname(p.date_id) AS day_name, is_future,
         CAST(round_even(trend * 10000.0, 0) AS BIGINT) AS trend_e4, CAST(round_even(weekly * 10000.0, 0) AS BIGINT) AS weekly_e4,
         CAST(round_even(yearly * 10000.0, 0) AS BIGINT) AS yearly_e4, CAST(round_even(holidays * 10000.0, 0) AS BIGINT) AS holidays_e4,
         CAST(round_even((trend + weekly + yearly + holidays) * 10000.0, 0) AS BIGINT) AS yhat_e4,
         CAST(round_even(qs.lo * 10000.0, 0) AS BIGINT) AS lower_e4, CAST(round_even(qs.hi * 10000.0, 0) AS BIGINT) AS upper_e4
  FROM parts p LEFT JOIN qs ON p.date_id = qs.date_id),
ahead_fc AS (SELECT * FROM full_fc WHERE date_id > (SELECT MAX(date_id) FROM ser)),
full_plan AS (SELECT *, {xround("greatest(upper_e4, 0)", "10000", 0, "half_even")} AS upper_whole FROM ahead_fc),
full_staff AS (SELECT *, {xround("CAST(upper_whole AS BIGINT) * 95000", "1000000", 0, "half_even")} AS peak_hour_orders FROM full_plan)"""


def with_demand(body: str, changepoints: int = 25) -> str:
    return with_star(body, _demand_ctes(changepoints)).replace("WITH ", "WITH RECURSIVE ", 1)


def _demand(spark, sf, spec: demand.Spec = demand.Spec()):
    ser = cut_lineage(series.gap_fill(series.daily_orders(star(spark, sf).fact), how="null"))
    days = demand.event_days(demand.dated_events(forecast.holiday_bounds(ser, HOLDOUT + HORIZON), forecast.HOLIDAYS))
    frame = forecast.future_frame(forecast.training_window(ser, HOLDOUT), HOLDOUT + HORIZON, value="total_orders")
    return ser, demand.fit(frame, days, value="total_orders", spec=spec)


def _demand_fc(spark, sf, spec: demand.Spec = demand.Spec()):
    ser, model = _demand(spark, sf, spec)
    return forecast.forecast_rows(demand.forecast(model, paths=PATHS, seed=SEED, future_only=True), ser)


def _e4_sql(*names: str) -> str:
    return ", ".join(f"CAST({n}_e4 AS DOUBLE) / 10000.0 AS {alias}" for n, alias in
                     ((n, {"lower": "yhat_lower", "upper": "yhat_upper"}.get(n, n)) for n in names))


@query("forecast_fit", "H", with_demand(f"""
SELECT term, level, round(estimate, 5) AS estimate FROM (
  SELECT 'intercept' AS term, CAST(NULL AS VARCHAR) AS level, beta[1] AS estimate FROM sol
  UNION ALL SELECT 'slope', NULL, beta[2] / span FROM sol, sp
  UNION ALL SELECT 'changepoint', printf('%02d', j), beta[2 + j] / span FROM sol, sp, range(1, 26) r(j)
  UNION ALL SELECT 'weekday', dayname(DATE '1970-01-01' + CAST(w AS INT)),
                   list_sum(list_transform(range(1, 4), lambda k: beta[26 + 2 * k] * sin(2 * pi() * k * w / 7.0)
                                                                + beta[27 + 2 * k] * cos(2 * pi() * k * w / 7.0)))
            FROM sol, range(0, 7) r(w)
  UNION ALL SELECT 'yearly', CASE WHEN j % 2 = 0 THEN 'sin ' ELSE 'cos ' END || printf('%02d', j // 2 + 1), beta[34 + j]
            FROM sol, range(0, 20) r(j)
  UNION ALL SELECT 'event', names[i], beta[53 + i] FROM sol, hn, range(1, len(hn.names) + 1) r(i)
  UNION ALL SELECT 'sigma', NULL, sigma FROM sg UNION ALL SELECT 'freedom', NULL, freedom FROM sg)"""))
def _full_fit(spark, sf):
    return demand.model_table(_demand(spark, sf)[1])


@query("forecast_predict", "H", with_demand(f"SELECT date_id, day_name, {_e4_sql('yhat', 'lower', 'upper')} FROM ahead_fc"))
def _full_predict(spark, sf):
    return _demand_fc(spark, sf).select("date_id", "day_name", "yhat", "yhat_lower", "yhat_upper")


@query("forecast_components", "H", with_demand(
    f"SELECT date_id, is_future, {_e4_sql('trend', 'weekly', 'yearly', 'holidays', 'yhat')} FROM full_fc"))
def _full_components(spark, sf):
    # Every date of the forecast frame: training history and the future.
    return forecast.components(demand.predict(_demand(spark, sf)[1]))


@query("staffing_plan", "H", with_demand(f"""
SELECT date_id, day_name, {_e4_sql('yhat', 'lower')}, upper_whole AS yhat_upper, peak_hour_orders,
       CAST(ceil(peak_hour_orders / 7.0) AS INT) AS staff_needed FROM full_staff"""))
def _full_staffing(spark, sf):
    return forecast.staffing(_demand_fc(spark, sf))


@query("staffing_report", "H", with_demand(f"""
SELECT date_id AS date, day_name, {xround("yhat_e4", "1000", 0, "half_even")} / 10.0 AS forecast_orders,
       {xround("lower_e4", "1000", 0, "half_even")} / 10.0 AS forecast_lower,
       {xround("round_even(upper_whole * 10000.0, 0)", "1000", 0, "half_even")} / 10.0 AS forecast_upper,
       peak_hour_orders AS forecast_peak_hour_orders, CAST(ceil(peak_hour_orders / 7.0) AS INT) AS staff_needed
FROM full_staff"""))
def _full_report(spark, sf):
    return forecast.report(forecast.staffing(_demand_fc(spark, sf)))


@query("forecast_predict_yearly", "H", with_demand(
    f"SELECT date_id, day_name, {_e4_sql('yhat', 'lower', 'upper')} FROM ahead_fc", changepoints=0))
def _predict_yearly(spark, sf):
    # A straight trend with weekly and yearly seasons: no changepoints, so noise alone makes the interval.
    return _demand_fc(spark, sf, demand.Spec(changepoints=0)).select("date_id", "day_name", "yhat", "yhat_lower", "yhat_upper")


@query("holiday_events", "H", with_star("""
SELECT holiday, CAST(ds + CAST(k AS INT) AS DATE) AS date_id, CAST(k AS INT) AS day_offset
FROM (SELECT holiday, ds, unnest(range(lo, hi + 1)) AS k FROM hd) w
WHERE ds + CAST(k AS INT) IN (SELECT date_id FROM frame)""", FC_CTES))
def _events(spark, sf):
    ser = cut_lineage(series.gap_fill(series.daily_orders(star(spark, sf).fact), how="null"))
    events = demand.dated_events(forecast.holiday_bounds(ser, HOLDOUT + HORIZON), forecast.HOLIDAYS)
    frame = forecast.future_frame(forecast.training_window(ser, HOLDOUT), HOLDOUT + HORIZON)
    return demand.event_days(events, frame)
