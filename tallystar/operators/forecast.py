"""Daily demand forecast and staffing plan.

The reference fits a Bayesian additive model on one machine. Here the model
is re-aimed as aggregates that Spark computes per series in one pass:

    y(t) = a + b*t + weekday[dow(t)] + sum(holiday[h] for h covering t) + e,
    e ~ N(0, sigma)

* a, b: least squares of y on the day index, from exact sums
  (n, sum t, sum y, sum t^2, sum t*y), so every engine gets the same bits;
* weekday[k]: mean residual of the trend on weekday k;
* holiday[h]: mean residual of trend + weekday on the days of holiday h
  (its window included); holidays with no training day get 0;
* sigma: sample standard deviation of the final residuals.

Interval: yhat +/- z * sigma with z the normal quantile of the interval width.
Every sum is a window aggregate over the series partitioning, so the model
is one shuffle by series plus a tiny holiday aggregate; ``keys`` carries a
series id so many series fit in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.scalar import day_name, exact_round, iso_weekday
from tallystar.session import cut_lineage


# The reference's holidays with their windows (lower, upper).
# Its list holds 2015 dates only; here each is a rule so any year of data
# gets its own dates (Thanksgiving = fourth Thursday of November, Black
# Friday the day after).
HOLIDAYS = [
    ("New Year", "fixed", 1, 1, 0, 0),
    ("Valentine's Day", "fixed", 2, 14, 0, 0),
    ("Independence Day", "fixed", 7, 4, 0, 0),
    ("Thanksgiving", "thanksgiving", 11, 0, 0, 0),
    ("Black Friday", "thanksgiving", 11, 1, 0, 0),
    ("Christmas", "fixed", 12, 25, -1, 0),
    ("Boxing Day", "fixed", 12, 26, 0, 0),
]
PEAK_HOUR_RATIO = 0.095      # share of daily orders in the peak hour
ORDERS_PER_STAFF_HOUR = 7    # orders one person handles per hour


def training_window(series: DataFrame, holdout: int = 14, keys: Sequence[str] = ()) -> DataFrame:
    """Drop the last ``holdout`` days of each series."""
    last = F.max("date_id").over(Window.partitionBy(*keys))
    return (series.withColumn("_last", last)
            .filter(F.col("date_id") <= F.date_sub(F.col("_last"), holdout)).drop("_last"))


def holiday_calendar(bounds: DataFrame, holidays=HOLIDAYS) -> DataFrame:
    """(holiday, date_id) for every year between ``min_date`` and ``max_date`` of
    ``bounds`` (one row), windows expanded. Years and rules are exploded as
    generators on the executors; nothing is joined against a literal grid."""
    rules = F.array(*[F.struct(F.lit(n).alias("holiday"), F.lit(kind).alias("kind"),
                               F.lit(m).alias("m"), F.lit(d).alias("d"),
                               F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
                      for n, kind, m, d, lo, hi in holidays])
    years = bounds.select(F.explode(F.sequence(F.year("min_date"), F.year("max_date"))).alias("y"))
    per = years.select("y", F.explode(rules).alias("r")).select("y", "r.*")
    nov1 = F.make_date(F.col("y"), F.lit(11), F.lit(1))
    thanks = F.date_add(nov1, ((F.lit(4) - iso_weekday(nov1) + 7) % 7 + 21).cast("int"))
    ds = F.when(F.col("kind") == "thanksgiving", F.date_add(thanks, F.col("d").cast("int"))) \
        .otherwise(F.make_date(F.col("y"), F.col("m"), F.col("d")))
    return (per.select("holiday", ds.alias("ds"), "lo", "hi")
            .select("holiday", F.explode(F.sequence(F.date_add("ds", F.col("lo")),
                                                    F.date_add("ds", F.col("hi")))).alias("date_id"))
            .filter(F.col("date_id").isNotNull()))


def _bounds(df: DataFrame, extra_days: int = 0) -> DataFrame:
    return df.agg(F.min("date_id").alias("min_date"),
                  F.date_add(F.max("date_id"), extra_days).alias("max_date"))


SERIES = "_series"


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A single series gets a constant key, so every per-series step is a
    ``PARTITION BY`` window or a join on that key, never a cross join."""
    if keys:
        return df, list(keys)
    return df.withColumn(SERIES, F.lit(0)), [SERIES]


def future_frame(train: DataFrame, periods: int = 44, value: str | None = None,
                 keys: Sequence[str] = ()) -> DataFrame:
    """Training history plus ``periods`` days after its end, in one pass: the
    last row of each series also emits the future days (``lead`` + ``explode``).
    ``value`` (if given) is carried for history rows and NULL in the future."""
    k = list(keys)
    w = Window.partitionBy(*k).orderBy("date_id")
    v = F.col(value) if value else F.lit(None).cast("double")
    vtype = train.schema[value].dataType if value else "double"
    rows = train.select(*k, "date_id", v.alias("_v"), F.lead("date_id").over(w).alias("_next"))
    future = F.when(F.col("_next").isNull(),
                    F.sequence(F.date_add("date_id", 1), F.date_add("date_id", periods))) \
        .otherwise(F.array().cast("array<date>"))
    me = F.array(F.struct(F.col("date_id").alias("d"), F.col("_v").alias("v"),
                          F.lit(False).alias("f")))
    fut = F.transform(future, lambda d: F.struct(d.alias("d"), F.lit(None).cast(vtype).alias("v"),
                                                 F.lit(True).alias("f")))
    out = rows.select(*k, F.explode(F.concat(me, fut)).alias("e")).select(
        *k, F.col("e.d").alias("date_id"), F.col("e.f").alias("is_future"),
        *([F.col("e.v").alias(value)] if value else []))
    return out


def fit(frame: DataFrame, holidays: DataFrame, value: str = "y", keys: Sequence[str] = (),
        interval: float = 0.90, materialize: bool = True) -> dict:
    """Fit on the history rows of ``frame`` and predict every row of it.

    All per-series and per-weekday sums are window aggregates over the same
    series partitioning (one shuffle by series), so the parameters land on
    every row without joining them back; only the holiday effects (one row
    per series and holiday) are aggregated and broadcast back. Returns the
    prediction frame and the parameter tables.
    """
    df, k = _keyed(frame, keys)
    W = Window.partitionBy(*k)
    Wd = Window.partitionBy(*k, "day_name")
    obs = (~F.col("is_future")) & F.col(value).isNotNull()
    # Grouped projections (withColumns) keep the plan to a few analysis steps.
    df = df.withColumns({"day_name": day_name("date_id"), "_obs": obs,
                         "yv": F.when(obs, F.col(value).cast("double"))})
    df = df.withColumn("origin", F.min(F.when(F.col("_obs"), F.col("date_id"))).over(W))
    df = df.withColumn("t", F.datediff("date_id", "origin").cast("double"))
    t, yv = F.col("t"), F.col("yv")
    one = F.when(F.col("_obs"), F.lit(1.0))
    tt = F.when(F.col("_obs"), t)
    df = df.withColumns({"_n": F.sum(one).over(W), "_st": F.sum(tt).over(W),
                         "_sy": F.sum(yv).over(W), "_stt": F.sum(tt * tt).over(W),
                         "_sty": F.sum(tt * yv).over(W), "_nk": F.sum(one).over(Wd),
                         "_stk": F.sum(tt).over(Wd), "_syk": F.sum(yv).over(Wd)})
    n, st, sy, stt, sty = (F.col(c) for c in ("_n", "_st", "_sy", "_stt", "_sty"))
    den = n * stt - st * st
    df = df.withColumn("b", F.when(den != 0, (n * sty - st * sy) / den).otherwise(0.0))
    df = df.withColumn("a", (sy - F.col("b") * st) / n)
    df = df.withColumn("w", (F.col("_syk") - F.col("a") * F.col("_nk") - F.col("b") * F.col("_stk"))
                       / F.col("_nk"))
    df = df.withColumn("r1", yv - F.col("a") - F.col("b") * t - F.coalesce("w", F.lit(0.0)))
    # Holiday effects: mean residual per (series, holiday) over history days.
    hol = (df.filter("_obs").select(*k, "date_id", "r1").join(F.broadcast(holidays), "date_id")
           .groupBy(*k, "holiday").agg(F.round(F.avg("r1"), 9).alias("effect")))
    hsum = (holidays.join(F.broadcast(hol), "holiday").groupBy(*k, "date_id")
            .agg(F.sum("effect").alias("_h")))
    z = NormalDist().inv_cdf(0.5 + interval / 2.0)
    df = (df.join(F.broadcast(hsum), [*k, "date_id"], "left")
          .withColumns({"holidays": F.coalesce("_h", F.lit(0.0)),
                        "weekly": F.coalesce("w", F.lit(0.0)),
                        "trend": F.col("a") + F.col("b") * t}))
    df = df.withColumns({
        "sigma": F.round(F.stddev_samp(F.col("r1") - F.col("holidays")).over(W), 9),
        "yhat": F.col("trend") + F.col("weekly") + F.col("holidays")})
    pred = df.withColumns({"yhat_lower": F.col("yhat") - F.lit(z) * F.col("sigma"),
                           "yhat_upper": F.col("yhat") + F.lit(z) * F.col("sigma")})
    pred = pred.select(*k, "date_id", "is_future", "day_name", "_obs", "origin", "a", "b", "w",
                       "sigma", "trend", "weekly", "holidays", "yhat", "yhat_lower", "yhat_upper")
    if materialize:
        # The fitted frame (series x days) feeds the prediction and four
        # parameter tables; write it once so the windows run once. Callers
        # that only read the predictions can skip this.
        pred = cut_lineage(pred)
    params = pred.filter("_obs")
    return {
        "pred": pred.select(*k, "date_id", "is_future", "day_name", "trend", "weekly", "holidays",
                            "yhat", "yhat_lower", "yhat_upper"),
        "trend": params.groupBy(*k).agg(F.first("origin").alias("origin"), F.first("a").alias("a"),
                                        F.first("b").alias("b")),
        "weekday": params.groupBy(*k, "day_name").agg(F.first("w").alias("effect")),
        "holiday": hol,
        "sigma": params.groupBy(*k).agg(F.first("sigma").alias("sigma")),
        "keys": k,
    }


def model_table(model: dict, keys: Sequence[str] = ()) -> DataFrame:
    """The fitted parameters as (term, level, estimate) rows."""
    k = list(keys)
    t = model["trend"]
    none = F.lit(None).cast("string")
    parts = [
        t.select(*k, F.lit("intercept").alias("term"), none.alias("level"), F.col("a").alias("estimate")),
        t.select(*k, F.lit("slope").alias("term"), none.alias("level"), F.col("b").alias("estimate")),
        model["weekday"].select(*k, F.lit("weekday").alias("term"), F.col("day_name").alias("level"),
                                F.col("effect").alias("estimate")),
        model["holiday"].select(*k, F.lit("holiday").alias("term"), F.col("holiday").alias("level"),
                                F.col("effect").alias("estimate")),
        model["sigma"].select(*k, F.lit("sigma").alias("term"), none.alias("level"),
                              F.col("sigma").alias("estimate")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("estimate", F.round("estimate", 6))


def predict(model: dict) -> DataFrame:
    """Components and interval for every date of the fitted frame."""
    return model["pred"]


def _e4(c: str) -> F.Column:
    """Value in ten-thousandths as a whole number (half-even)."""
    return F.bround(F.col(c) * 10000.0, 0).cast("long")


def forecast_rows(pred: DataFrame, observed: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Dates after the end of the observed series, values to 4 decimals.

    Per series the end date is joined on the series keys; a single series
    compares with a scalar subquery (no key-less join).
    """
    k = list(keys)
    if k:
        end = observed.groupBy(*k).agg(F.max("date_id").alias("_end"))
        df = pred.join(F.broadcast(end), k).filter(F.col("date_id") > F.col("_end"))
    else:
        df = pred.filter(F.col("date_id") > observed.agg(F.max("date_id")).scalar())
    return df.select(*k, "date_id", "day_name",
                     *[(_e4(c).cast("double") / 10000.0).alias(c) for c in
                       ("yhat", "yhat_lower", "yhat_upper", "trend", "weekly", "yearly", "holidays") if c in df.columns])


def components(pred: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Trend, weekly, yearly (if the model has it) and holiday parts of the
    prediction for every frame date."""
    return pred.select(*keys, "date_id", "is_future",
                       *[(_e4(c).cast("double") / 10000.0).alias(c) for c in
                         ("trend", "weekly", "yearly", "holidays", "yhat") if c in pred.columns])


def staffing(fc: DataFrame, peak_ratio: float = PEAK_HOUR_RATIO,
             per_staff: int = ORDERS_PER_STAFF_HOUR, keys: Sequence[str] = ()) -> DataFrame:
    """Upper bound -> peak-hour orders -> people, with half-even rounding
    done on exact integers (ten-thousandths of an order). Each step is its
    own projection over the previous column, so expressions stay small."""
    ratio_e6 = int(round(peak_ratio * 1_000_000))
    return (fc.withColumn("_upper_e4", F.greatest(_e4("yhat_upper"), F.lit(0)))
            .withColumn("yhat_upper", exact_round("_upper_e4", F.lit(10000), 0, "half_even"))
            .withColumn("peak_hour_orders",
                        exact_round(F.col("yhat_upper").cast("long") * ratio_e6,
                                    F.lit(1_000_000), 0, "half_even"))
            .select(*keys, "date_id", day_name("date_id").alias("day_name"),
                    "yhat", "yhat_lower", "yhat_upper", "peak_hour_orders",
                    F.ceil(F.col("peak_hour_orders") / F.lit(float(per_staff))).cast("int")
                    .alias("staff_needed")))


def report(plan: DataFrame) -> DataFrame:
    """The exported staffing report: renamed columns, forecasts to 1 decimal."""
    cols = {c: f"_{c}_e4" for c in ("yhat", "yhat_lower", "yhat_upper")}
    staged = plan.withColumns({e4: _e4(c) for c, e4 in cols.items()})
    one = {c: exact_round(e4, F.lit(1000), 0, "half_even") / 10.0 for c, e4 in cols.items()}
    return staged.select(F.col("date_id").alias("date"), "day_name",
                         one["yhat"].alias("forecast_orders"),
                         one["yhat_lower"].alias("forecast_lower"),
                         one["yhat_upper"].alias("forecast_upper"),
                         F.col("peak_hour_orders").alias("forecast_peak_hour_orders"),
                         "staff_needed").orderBy("date")


def peak_ratio(hourly: DataFrame) -> DataFrame:
    """Share of all orders that fall in the busiest hour (ties: earliest hour).

    ``hourly`` has one row per hour, so both windows run over 24 rows.
    """
    w = Window.orderBy(F.desc("total_orders"), "hour")
    return (hourly.withColumn("_rn", F.row_number().over(w))
            .withColumn("all_orders", F.sum("total_orders").over(Window.partitionBy()))
            .filter(F.col("_rn") == 1)
            .select(F.col("hour").alias("peak_hour"), F.col("total_orders").alias("peak_orders"),
                    "all_orders")
            .withColumn("peak_ratio", exact_round("peak_orders", "all_orders", 4)))


def holiday_bounds(series: DataFrame, extra_days: int = 0) -> DataFrame:
    """One-row (min_date, max_date + extra_days) frame for ``holiday_calendar``."""
    return _bounds(series, extra_days)
