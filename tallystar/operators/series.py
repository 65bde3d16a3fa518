"""Time series: daily/weekly/monthly/hourly aggregates, gap filling and
seasonal decomposition (SURVEY 2-G).

Every series operator takes optional ``keys`` (series id columns) so that
thousands of series (per product, per store) are processed in parallel:
windows are ``PARTITION BY keys`` and the per-key frames are bounded by the
calendar, not by the order volume.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.scalar import (COMPONENT_LABELS, cents, day_name, exact_round,
                                        from_cents)
from tallystar.operators.dates import on_date
from tallystar.session import cut_lineage

B = F.broadcast


def _measures(units: bool = True, revenue: bool = True):
    out = [F.countDistinct("order_id").alias("total_orders")]
    if units:
        out.append(F.sum("quantity").cast("long").alias("total_units"))
    if revenue:
        out.append(F.sum(cents("total_price")).alias("_rev"))
    return out


def _money_cols(df: DataFrame, aov: bool = True) -> DataFrame:
    if aov:
        df = df.withColumn("avg_order_value",
                           exact_round("_rev", F.col("total_orders") * 100, 2))
    return df.withColumn("total_revenue", from_cents("_rev")).drop("_rev")


# G1-G4 ---------------------------------------------------------------------
def daily_series(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    df = (on_date(fact, dim_date, "day_of_week", "day_name", "is_weekend")
          .groupBy("date_id", "day_of_week", "day_name", "is_weekend").agg(*_measures()))
    return _money_cols(df).orderBy("date_id")


def weekly_series(fact: DataFrame, dim_date: DataFrame, iso_year: bool = False) -> DataFrame:
    """(year, ISO week) buckets. ``iso_year=False`` pairs the calendar year with
    the ISO week as the reference does, so 1 Jan can land in week 52/53 of its
    own year; ``iso_year=True`` uses the ISO week-numbering year."""
    rows = on_date(fact, dim_date, "year", "week")
    if iso_year:
        rows = rows.withColumn("year", F.expr("extract(YEAROFWEEK FROM date_id)").cast("int"))
    df = (rows.groupBy("year", "week")
          .agg(F.min("date_id").alias("week_start_date"), *_measures()))
    if iso_year:
        df = df.withColumnRenamed("year", "iso_year")
    return _money_cols(df).orderBy(df.columns[0], "week")


def monthly_series(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    df = (on_date(fact, dim_date, "year", "month", "month_name")
          .groupBy("year", "month", "month_name").agg(*_measures()))
    return _money_cols(df).orderBy("year", "month")


def hourly_series(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    dt = dim_time.select("time_id", "hour", "meal_period")
    df = (fact.join(B(dt), "time_id").groupBy("date_id", "hour", "meal_period")
          .agg(*_measures()))
    return _money_cols(df, aov=False).orderBy("date_id", "hour")


# G5, G6 --------------------------------------------------------------------
def daily_by_period(fact: DataFrame, dim_time: DataFrame, dim_date: DataFrame | None = None,
                    exclude: Sequence[str] = ("Morning",)) -> DataFrame:
    """Daily orders and revenue per meal period (optionally with the weekday)."""
    dt = dim_time.select("time_id", "meal_period")
    if exclude:
        dt = dt.filter(~F.col("meal_period").isin(*exclude))
    df = fact.join(B(dt), "time_id")
    keys = ["date_id", "meal_period"]
    if dim_date is not None:
        df = on_date(df, dim_date, "day_name")
        keys = ["date_id", "day_name", "meal_period"]
    out = df.groupBy(*keys).agg(F.countDistinct("order_id").alias("daily_orders"),
                                F.sum(cents("total_price")).alias("_rev"))
    return out.withColumn("daily_revenue", from_cents("_rev")).drop("_rev").orderBy(*keys)


def daily_by_weekday(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    out = (on_date(fact, dim_date, "day_name", "day_of_week").groupBy("date_id", "day_name", "day_of_week")
           .agg(F.countDistinct("order_id").alias("daily_orders"),
                F.sum(cents("total_price")).alias("_rev")))
    return out.withColumn("daily_revenue", from_cents("_rev")).drop("_rev").orderBy("date_id")


def daily_orders(fact: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Distinct orders per day (per series): the input of fill/decompose/forecast."""
    return (fact.groupBy(*keys, "date_id")
            .agg(F.countDistinct("order_id").alias("total_orders")))


# G7-G9 ---------------------------------------------------------------------
def _complete(series: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Every calendar day between each series' first and last day, in one pass.

    Each observed row emits itself plus the missing days up to the next
    observed day (``lead`` over the date-ordered series). There is no
    calendar aggregate joined back to the series, so the upstream (a scan
    and aggregate of the fact) is evaluated once.
    """
    vtype = series.schema[value].dataType
    w = Window.partitionBy(*keys).orderBy("date_id")
    nxt = F.lead("date_id").over(w)
    rows = series.select(*keys, "date_id", F.col(value), nxt.alias("_next"))
    gap = F.when(F.datediff("_next", "date_id") > 1,
                 F.sequence(F.date_add("date_id", 1), F.date_sub("_next", 1))) \
        .otherwise(F.array().cast("array<date>"))
    me = F.array(F.struct(F.col("date_id").alias("d"), F.col(value).alias("v"),
                          F.lit(False).alias("imputed")))
    fill = F.transform(gap, lambda d: F.struct(d.alias("d"), F.lit(None).cast(vtype).alias("v"),
                                               F.lit(True).alias("imputed")))
    return (rows.select(*keys, F.explode(F.concat(me, fill)).alias("e"))
            .select(*keys, F.col("e.d").alias("date_id"), F.col("e.v").alias(value),
                    F.col("e.imputed").alias("is_imputed")))


def missing_days(series: DataFrame, keys: Sequence[str] = (), value: str = "total_orders") -> DataFrame:
    """Calendar days with no observation (the anti join of calendar and series)."""
    return (_complete(series, value, keys).filter("is_imputed")
            .select(*keys, "date_id").orderBy(*keys, "date_id"))


def gap_fill(series: DataFrame, value: str = "total_orders", how: str = "dow_median",
             keys: Sequence[str] = ()) -> DataFrame:
    """Complete calendar per series.

    ``how="null"`` leaves missing days NULL; ``how="dow_median"`` fills them
    with the exact median of the observed days of the same weekday (a window
    aggregate per series and weekday), rounded half-even (R's round), and
    flags them ``is_imputed``.
    """
    full = _complete(series, value, keys)
    if how == "null":
        return full.select(*keys, "date_id", value).orderBy(*keys, "date_id")
    if how != "dow_median":
        raise ValueError(how)
    med = F.median(value).over(Window.partitionBy(*keys, day_name("date_id")))
    filled = F.coalesce(F.col(value).cast("long"), F.bround(med, 0).cast("long"))
    return (full.select(*keys, "date_id", filled.alias(value), "is_imputed")
            .orderBy(*keys, "date_id"))


# G10 -----------------------------------------------------------------------
def decompose(series: DataFrame, value: str = "total_orders", period: int = 7,
              robust_iters: int = 0, keys: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Additive decomposition observed = trend + seasonal + remainder.

    trend: centred moving average over ``period`` days (partial at the ends);
    seasonal: mean detrended value per position in the cycle, centred to sum
    to zero; remainder: the rest. ``robust_iters`` > 0 repeats trend and
    seasonal with bisquare weights from 6 x median |remainder| per series, so
    outlier days stop pulling the components. This is a Spark-native
    stand-in for loess STL: same components, not the same numbers.
    """
    # The series feeds several branches (windows, per-position means, robust
    # rounds) that Spark cannot share once columns are pruned differently;
    # checkpointing the (calendar-sized) input keeps the upstream to one run.
    series = cut_lineage(series.select(*keys, "date_id", value))
    half = period // 2
    order = Window.partitionBy(*keys).orderBy("date_id")
    frame = order.rowsBetween(-half, half)
    first = F.min("date_id").over(Window.partitionBy(*keys))
    base = (series.select(*keys, "date_id", F.col(value).cast("double").alias("observed"))
            .withColumn("_pos", (F.datediff("date_id", first) % period).cast("int"))
            .withColumn("_w", F.lit(1.0)))

    def components(df: DataFrame) -> DataFrame:
        wy = F.sum(F.col("_w") * F.col("observed")).over(frame)
        ws = F.sum("_w").over(frame)
        df = df.withColumn("trend", F.when(ws > 0, wy / ws).otherwise(F.avg("observed").over(frame)))
        df = df.withColumn("_detr", F.col("observed") - F.col("trend"))
        pos = (df.groupBy(*keys, "_pos")
               .agg(F.when(F.sum("_w") > 0, F.sum(F.col("_w") * F.col("_detr")) / F.sum("_w"))
                    .otherwise(F.avg("_detr")).alias("_s")))
        pos = pos.withColumn("_s", F.col("_s") - F.avg("_s").over(Window.partitionBy(*keys)))
        df = df.drop("_s").join(B(pos), [*keys, "_pos"])
        return (df.withColumn("seasonal", F.col("_s"))
                .withColumn("remainder", F.col("observed") - F.col("trend") - F.col("seasonal")))

    df = components(base)
    for _ in range(robust_iters):
        h = (df.groupBy(*keys).agg((F.lit(6.0) * F.median(F.abs("remainder"))).alias("_h")))
        u = F.abs("remainder") / F.col("_h")
        w = F.when(F.col("_h") <= 0, F.lit(1.0)).when(u < 1, (1 - u * u) * (1 - u * u)).otherwise(0.0)
        # One median per series: joined per key, or a scalar subquery for a single series.
        df = df.join(B(h), list(keys), "left") if keys else df.withColumn("_h", h.scalar())
        # Each robust round reads the previous one several times: cut the
        # (calendar-sized) lineage so rounds do not re-plan their ancestors.
        df = components(cut_lineage(df.withColumn("_w", w)
                                    .select(*keys, "date_id", "observed", "_pos", "_w")))
    return (df.select(*keys, "date_id", "observed",
                      *[F.round(c, digits).alias(c) for c in ("trend", "seasonal", "remainder")])
            .orderBy(*keys, "date_id"))


# G11-G13 -------------------------------------------------------------------
def trim_tail(df: DataFrame, column: str = "trend", days: int = 21,
              keys: Sequence[str] = ()) -> DataFrame:
    """Blank ``column`` in the last ``days`` days of each series (edge artefacts)."""
    last = F.max("date_id").over(Window.partitionBy(*keys))
    return df.withColumn(column, F.when(F.col("date_id") > F.date_sub(last, days), F.lit(None))
                         .otherwise(F.col(column)))


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], labels: dict | None = None,
            name: str = "component", value: str = "value") -> DataFrame:
    """Wide -> long, keeping NULL cells (like pivot_longer)."""
    long = df.unpivot(list(ids), list(values), name, value)
    if labels:
        expr = None
        for k, v in labels.items():
            expr = F.when(F.col(name) == k, v) if expr is None else expr.when(F.col(name) == k, v)
        long = long.withColumn(name, expr)
    return long


def decompose_long(decomp: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return to_long(decomp, [*keys, "date_id"], list(COMPONENT_LABELS), COMPONENT_LABELS)


def decompose_summary(decomp: DataFrame, keys: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Min, quartiles (linear interpolation, R type 7), mean and max per component."""
    long = to_long(decomp, [*keys, "date_id"], list(COMPONENT_LABELS))
    v = F.col("value")
    stats = [F.min(v).alias("min"), F.percentile(v, 0.25).alias("q1"),
             F.percentile(v, 0.5).alias("median"), F.avg(v).alias("mean"),
             F.percentile(v, 0.75).alias("q3"), F.max(v).alias("max")]
    out = long.groupBy(*keys, "component").agg(*stats)
    return out.select(*keys, "component",
                      *[F.round(c, digits).alias(c) for c in ("min", "q1", "median", "mean", "q3", "max")])
