"""Demand model with changepoints, weekly and yearly seasons and dated events,
for many series at once (SURVEY H2, H3, H5, H6).

    y(d) = m + k t + sum_j delta_j (t - s_j)+ + weekly(d) + yearly(d)
           + sum of the effects of the events that cover d + e,  e ~ N(0, sigma)

t runs from 0 to 1 over a series' observed days, the s_j are spread evenly
over the first ``changepoint_range`` of it, the seasons are Fourier sums of
the day number. All coefficients come from one ridge least squares: a strong
penalty on the slope changes keeps the trend calm, the others only keep the
system solvable.

The fit is a keyed aggregate. Each (series, stretch of ``STRETCH_DAYS`` days)
gives one row of moments (X'X, X'y, y'y, n); rows of one series add up, so
the moments of new days can be added to stored ones, and a series of any
length never gathers in one call. Every series is then one Cholesky solve.
Spark deals the rows by series once, for the observed span and the moments;
after that only moment rows (one for each stretch) and models move.

The interval has two parts. Observation noise is normal with the fitted
sigma. The trend of the future may change slope as often and as far as it did
in the past: paths draw, for each future day, whether the slope changes and by
how much (Laplace with the mean size of the fitted changes), and the bounds
are quantiles over the paths. Draws come from a hash of (seed, series, path,
day), so a run can be repeated anywhere.

Null values are skipped; a series without any value gets no model and no
prediction; a day without events has an event part of 0, events never seen in
training too. One observed day gives a constant.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallystar.functions.scalar import day_name, iso_weekday

STRETCH_DAYS = 4096
SERIES = "_series"
PARTS = ("trend", "weekly", "yearly", "holidays")


@dataclass(frozen=True)
class Spec:
    """Shape and penalties of the model."""
    changepoints: int = 25
    changepoint_range: float = 0.8
    weekly_order: int = 3
    yearly_order: int = 10
    trend_penalty: float = 1e-9
    changepoint_penalty: float = 2.0
    season_penalty: float = 1e-4
    event_penalty: float = 1e-4

    @property
    def sizes(self) -> tuple[int, int, int, int]:
        return 2, self.changepoints, 2 * self.weekly_order, 2 * self.yearly_order

    def penalties(self, events: int) -> np.ndarray:
        a, b, c, d = self.sizes
        return np.concatenate((np.full(a, self.trend_penalty), np.full(b, self.changepoint_penalty),
                               np.full(c + d, self.season_penalty), np.full(events, self.event_penalty)))

    def design(self, day: np.ndarray, origin: int, span: int) -> np.ndarray:
        """Columns of the day numbers ``day``: trend, changepoints, seasons."""
        t = (day - origin) / span
        s = self.changepoint_range * np.arange(1, self.changepoints + 1) / max(self.changepoints, 1)
        columns = [np.ones_like(t), t, *np.maximum(t[:, None] - s, 0.0).T]
        for period, order in ((7.0, self.weekly_order), (365.25, self.yearly_order)):
            for k in range(1, order + 1):
                angle = 2 * math.pi * k * day / period
                columns += [np.sin(angle), np.cos(angle)]
        return np.stack(columns, axis=1)


# --- events -------------------------------------------------------------------

def dated_events(bounds: DataFrame, rules) -> DataFrame:
    """(holiday, ds, lower_window, upper_window) of each rule in every year
    between ``min_date`` and ``max_date`` of the one row of ``bounds``."""
    rows = F.array(*[F.struct(F.lit(name).alias("holiday"), F.lit(kind).alias("kind"), F.lit(month).alias("month"),
                              F.lit(day).alias("day"), F.lit(low).alias("lower_window"), F.lit(high).alias("upper_window"))
                     for name, kind, month, day, low, high in rules])
    years = bounds.select(F.explode(F.sequence(F.year("min_date"), F.year("max_date"))).alias("year"))
    each = years.select("year", F.explode(rows).alias("r")).select("year", "r.*")
    november = F.make_date("year", F.lit(11), F.lit(1))
    fourth_thursday = F.date_add(november, ((F.lit(4) - iso_weekday(november) + 7) % 7 + 21).cast("int"))
    ds = F.when(F.col("kind") == "thanksgiving", F.date_add(fourth_thursday, F.col("day").cast("int"))).otherwise(
        F.make_date("year", "month", "day"))
    return each.select("holiday", ds.alias("ds"), "lower_window", "upper_window")


def event_days(events: DataFrame, calendar: DataFrame | None = None) -> DataFrame:
    """(holiday, date_id, day_offset): every day from ``lower_window`` before to
    ``upper_window`` after each row's ``ds``. Windows may overlap; each covering
    row gives a row of its own. An empty window (lower above upper) or a null
    date gives none. With ``calendar`` only its dates stay."""
    low, high = F.coalesce("lower_window", F.lit(0)), F.coalesce("upper_window", F.lit(0))
    offsets = F.when(low <= high, F.sequence(low.cast("int"), high.cast("int"))).otherwise(F.array().cast("array<int>"))
    days = (events.where(F.col("ds").isNotNull())
            .select("holiday", "ds", F.explode(offsets).alias("day_offset"))
            .select("holiday", F.date_add(F.col("ds").cast("date"), F.col("day_offset")).alias("date_id"), "day_offset"))
    return days if calendar is None else days.join(calendar.select("date_id").distinct(), "date_id").select(*days.columns)


# --- fit ------------------------------------------------------------------------

def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    return (df, list(keys)) if keys else (df.withColumn(SERIES, F.lit(0)), [SERIES])


def prepare(frame: DataFrame, days: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """Rows of the model: day number, value, events of the day, observed span."""
    names = days.groupBy("date_id").agg(F.sort_array(F.collect_list("holiday")).alias("events"))
    rows = frame.join(names, "date_id", "left")
    y = F.when(~F.col("is_future"), F.col(value).cast("double"))
    whole = Window.partitionBy(*keys)
    day = F.unix_date("date_id").cast("long")
    seen = F.when(y.isNotNull(), day)
    return rows.select(*keys, "date_id", "is_future", day.alias("day"), y.alias("y"),
                       F.coalesce("events", F.array().cast("array<string>")).alias("events"),
                       F.min(seen).over(whole).alias("origin"),
                       F.greatest(F.max(seen).over(whole) - F.min(seen).over(whole), F.lit(1)).alias("span"))


def _event_columns(events: pd.Series, names: list[str]) -> np.ndarray:
    place = {name: k for k, name in enumerate(names)}
    out = np.zeros((len(events), len(names)))
    for row, own in enumerate(events):
        for name in own:
            if name in place:
                out[row, place[name]] += 1.0
    return out


_MOMENTS = "origin long, span long, n long, names array<string>, xtx array<double>, xty array<double>, yty double"


def moments(prepared: DataFrame, keys: Sequence[str], spec: Spec) -> DataFrame:
    """One row of moments for each series and stretch of days. Rows are added in
    order of day, however they arrive, so repeated runs give equal sums."""
    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["day", "y"])
        names = sorted({name for own in pdf["events"] for name in own})
        origin, span = int(pdf["origin"].iloc[0]), int(pdf["span"].iloc[0])
        x = np.hstack((spec.design(pdf["day"].to_numpy(dtype=np.float64), origin, span), _event_columns(pdf["events"], names)))
        y = pdf["y"].to_numpy()
        return pd.DataFrame([{**{k: pdf[k].iloc[0] for k in keys}, "origin": origin, "span": span, "n": len(y),
                              "names": names, "xtx": (x.T @ x).ravel(), "xty": x.T @ y, "yty": float(y @ y)}])

    schema = ", ".join(f"`{k}` {prepared.schema[k].dataType.simpleString()}" for k in keys)
    return (prepared.where(F.col("y").isNotNull() & ~F.isnan("y"))
            .withColumn("_stretch", F.floor(F.col("day") / STRETCH_DAYS))
            .groupBy(*keys, "_stretch").applyInPandas(lambda pdf: fold(pdf), f"{schema}, {_MOMENTS}"))


def added(rows: pd.DataFrame, base: int) -> tuple[list[str], np.ndarray, np.ndarray, float, int]:
    """Sum of moment rows of one series; event columns are matched by name."""
    names = sorted({name for own in rows["names"] for name in own})
    p = base + len(names)
    xtx, xty = np.zeros((p, p)), np.zeros(p)
    for own, a, b in zip(rows["names"], rows["xtx"], rows["xty"]):
        at = np.concatenate((np.arange(base), base + np.searchsorted(names, list(own)).astype(int)))
        xtx[np.ix_(at, at)] += np.asarray(a).reshape(len(at), len(at))
        xty[at] += np.asarray(b)
    return names, xtx, xty, float(rows["yty"].sum()), int(rows["n"].sum())


_MODEL = ("origin long, span long, n long, names array<string>, beta array<double>, sigma double, freedom double")


def solve(moment_rows: DataFrame, keys: Sequence[str], spec: Spec) -> DataFrame:
    """Ridge coefficients, residual sigma and used degrees of freedom of each series."""
    base = sum(spec.sizes)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["yty", "n"])                              # one order of adding in every run
        names, xtx, xty, yty, n = added(pdf, base)
        penalty = spec.penalties(len(names))
        factor = np.linalg.cholesky(xtx + np.diag(penalty))
        half = np.linalg.solve(factor, np.eye(len(penalty)))
        inverse = half.T @ half
        beta = inverse @ xty
        beta += inverse @ (xty - (xtx @ beta + penalty * beta))           # one step of refinement
        freedom = len(beta) - float((penalty * np.diag(inverse)).sum())
        left = max(yty - 2 * float(beta @ xty) + float(beta @ xtx @ beta), 0.0)
        first = pdf.iloc[0]
        return pd.DataFrame([{**{k: first[k] for k in keys}, "origin": first["origin"], "span": first["span"], "n": n,
                              "names": names, "beta": beta, "sigma": math.sqrt(left / max(n - freedom, 1.0)),
                              "freedom": freedom}])

    schema = ", ".join(f"`{k}` {moment_rows.schema[k].dataType.simpleString()}" for k in keys)
    return moment_rows.groupBy(*keys).applyInPandas(lambda pdf: fit(pdf), f"{schema}, {_MODEL}")


def fit(frame: DataFrame, days: DataFrame, value: str = "y", keys: Sequence[str] = (), spec: Spec = Spec()) -> dict:
    """Model of every series: history rows of ``frame`` are fitted, all its rows
    can be predicted. ``days``: (holiday, date_id) from ``event_days``."""
    df, k = _keyed(frame, keys)
    prepared = prepare(df, days, value, k)
    model = solve(moments(prepared, k, spec), k, spec)
    return {"prepared": prepared, "model": model, "keys": k, "out_keys": list(keys), "spec": spec}


def predict(fitted: dict, future_only: bool = False) -> DataFrame:
    """trend, weekly, yearly, holidays and yhat of the frame's dates, with the
    sigma, slope change size and rate that the interval needs."""
    keys, spec = fitted["keys"], fitted["spec"]
    a, b, c, d = spec.sizes
    edges = np.cumsum([0, a + b, c, d])
    rows = fitted["prepared"].where("is_future") if future_only else fitted["prepared"]

    def apply(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({name: pd.Series(dtype=object) for name in columns})
        left = left.sort_values("day")
        model = right.iloc[0]
        beta, names = np.asarray(model["beta"]), list(model["names"])
        x = spec.design(left["day"].to_numpy(dtype=np.float64), int(model["origin"]), int(model["span"]))
        parts = [x[:, low:high] @ beta[low:high] for low, high in zip(edges[:-1], edges[1:])]
        parts.append(_event_columns(left["events"], names) @ beta[edges[-1]:])
        changes = np.abs(beta[a:a + b])
        out = left[[*keys, "date_id", "is_future", "day"]].copy()
        for name, part in zip(PARTS, parts):
            out[name] = part
        return out.assign(yhat=sum(parts), sigma=model["sigma"], last_day=int(model["origin"]) + int(model["span"]),
                          span=int(model["span"]), change_size=float(changes.mean()) if b else 0.0,
                          change_rate=min(1.0, b / int(model["span"])))

    fields = [*((k, rows.schema[k].dataType.simpleString()) for k in keys), ("date_id", "date"), ("is_future", "boolean"),
              ("day", "long"), *((name, "double") for name in (*PARTS, "yhat", "sigma")), ("last_day", "long"),
              ("span", "long"), ("change_size", "double"), ("change_rate", "double")]
    columns = [name for name, _ in fields]
    return (rows.groupBy(*keys).cogroup(fitted["model"].groupBy(*keys))
            .applyInPandas(lambda left, right: apply(left, right), ", ".join(f"`{n}` {kind}" for n, kind in fields)))


# --- interval ---------------------------------------------------------------------

def uniform(digest: Column, draw: int) -> Column:
    """A number in (0, 1) from 8 of the 32 hex digits of an MD5 digest."""
    return (F.conv(F.substring(digest, 8 * draw + 1, 8), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 32))


def intervals(pred: DataFrame, keys: Sequence[str], interval: float = 0.90, paths: int = 500, seed: int = 0) -> DataFrame:
    """``pred`` with yhat_lower and yhat_upper. History days: noise alone.
    Future days: quantiles over ``paths`` draws of slope changes and noise.

    The only wide step is one row for each future day and path; running sums
    per path give the trend's departure, a quantile aggregate folds the paths.
    """
    k = list(keys)
    low, high = (1 - interval) / 2, (1 + interval) / 2
    future = pred.where("is_future").select(*k, "date_id", "day", "last_day", "span", "yhat", "sigma", "change_size", "change_rate")
    drawn = future.withColumn("path", F.explode(F.sequence(F.lit(0), F.lit(paths - 1))))
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in k],
                               F.col("path").cast("string"), F.col("day").cast("string")))
    drawn = drawn.withColumn("_digest", digest)
    u = [uniform(F.col("_digest"), i) for i in range(4)]
    laplace = -F.col("change_size") * F.signum(u[1] - 0.5) * F.log(F.lit(1.0) - 2.0 * F.abs(u[1] - 0.5))
    normal = F.sqrt(F.lit(-2.0) * F.log(u[2])) * F.cos(F.lit(2 * math.pi) * u[3])
    drawn = drawn.withColumns({"_change": F.when(u[0] < F.col("change_rate"), laplace).otherwise(0.0), "_noise": normal})
    run = Window.partitionBy(*k, "path").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = (F.col("day") - F.col("last_day")).cast("double")
    drawn = drawn.withColumns({"_sum": F.sum("_change").over(run), "_at": F.sum(F.col("_change") * ahead).over(run)})
    value = (F.col("yhat") + (ahead * F.col("_sum") - F.col("_at")) / F.col("span") + F.col("sigma") * F.col("_noise"))
    bounds = (drawn.withColumn("_value", value).groupBy(*k, "date_id")
              .agg(F.percentile("_value", F.array(F.lit(low), F.lit(high))).alias("_q")))
    z = NormalDist().inv_cdf(high)
    out = pred.join(bounds, [*k, "date_id"], "left")
    return out.withColumns({"yhat_lower": F.coalesce(F.col("_q")[0], F.col("yhat") - F.lit(z) * F.col("sigma")),
                            "yhat_upper": F.coalesce(F.col("_q")[1], F.col("yhat") + F.lit(z) * F.col("sigma"))}).drop("_q")


def forecast(fitted: dict, interval: float = 0.90, paths: int = 500, seed: int = 0, future_only: bool = False) -> DataFrame:
    """Prediction and interval, with the day's name; a lone series has no key column."""
    out = intervals(predict(fitted, future_only), fitted["keys"], interval, paths, seed)
    return out.select(*fitted["out_keys"], "date_id", "is_future", day_name("date_id").alias("day_name"), *PARTS, "yhat",
                      "yhat_lower", "yhat_upper")


def model_table(fitted: dict) -> DataFrame:
    """The coefficients as (term, level, estimate) rows: intercept and slope per
    day, changepoints by their share of the span, weekday effects, Fourier
    terms of the year, events, sigma and degrees of freedom."""
    keys, spec = fitted["out_keys"], fitted["spec"]
    a, b, c, d = spec.sizes
    m = fitted["model"]
    beta = F.col("beta")
    one = lambda term, level, value: F.struct(F.lit(term).alias("term"), level.cast("string").alias("level"),
                                              value.cast("double").alias("estimate"))
    none = F.lit(None)
    rows = [one("intercept", none, beta[0]), one("slope", none, beta[1] / F.col("span"))]
    rows += [one("changepoint", F.lit(f"{j:02d}"), beta[a + j - 1] / F.col("span")) for j in range(1, b + 1)]
    for offset, name in enumerate(("Thursday", "Friday", "Saturday", "Sunday", "Monday", "Tuesday", "Wednesday")):
        waves = [(math.sin(2 * math.pi * k * offset / 7), math.cos(2 * math.pi * k * offset / 7))
                 for k in range(1, spec.weekly_order + 1)]
        effect = sum((F.lit(s) * beta[a + b + 2 * k] + F.lit(w) * beta[a + b + 2 * k + 1] for k, (s, w) in enumerate(waves)),
                     F.lit(0.0))
        rows.append(one("weekday", F.lit(name), effect))
    rows += [one("yearly", F.lit(f"{'sin' if j % 2 == 0 else 'cos'} {j // 2 + 1:02d}"), beta[a + b + c + j]) for j in range(d)]
    rows += [one("sigma", none, F.col("sigma")), one("freedom", none, F.col("freedom"))]
    events = F.transform("names", lambda name, i: F.struct(F.lit("event").alias("term"), name.alias("level"),
                                                          F.element_at(beta, i + F.lit(a + b + c + d + 1)).alias("estimate")))
    return (m.select(*keys, F.explode(F.concat(F.array(*rows), events)).alias("e"))
            .select(*keys, "e.term", "e.level", F.round("e.estimate", 5).alias("estimate")))
