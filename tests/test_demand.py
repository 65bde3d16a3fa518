"""The full demand model: ridge moments by series, seasons, events, interval."""

import datetime as dt
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar.operators import demand, forecast

EVENTS = "holiday string, ds date, lower_window int, upper_window int"
# The reference's seven event rows.
SEVEN = [("New Year", dt.date(2015, 1, 1), 0, 0), ("Valentine's Day", dt.date(2015, 2, 14), 0, 0),
         ("Independence Day", dt.date(2015, 7, 4), 0, 0), ("Thanksgiving", dt.date(2015, 11, 26), 0, 0),
         ("Black Friday", dt.date(2015, 11, 27), 0, 0), ("Christmas", dt.date(2015, 12, 25), -1, 0),
         ("Boxing Day", dt.date(2015, 12, 26), 0, 0)]


def make(spark, series, start=dt.date(2015, 1, 1), events=(), horizon=30, **kw):
    rows = [(key, start + dt.timedelta(days=i), None if v is None else float(v))
            for key, values in series.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "sid string, date_id date, y double")
    days = demand.event_days(spark.createDataFrame(list(events), EVENTS))
    frame = forecast.future_frame(df, horizon, value="y", keys=["sid"])
    return demand.fit(frame, days, keys=["sid"], **kw)


def numpy_fit(values, start, events, spec):
    """Ridge least squares by an augmented QR system."""
    day = np.array([(start - dt.date(1970, 1, 1)).days + i for i in range(len(values))], dtype=float)
    known = np.array([v is not None for v in values])
    y = np.array([v if v is not None else np.nan for v in values])[known]
    d = day[known]
    names = sorted({name for name, _, _, _ in events})
    cover = {name: [0.0] * len(d) for name in names}
    for name, ds, low, high in events:
        for i, one in enumerate(d):
            off = one - (ds - dt.date(1970, 1, 1)).days
            cover[name][i] += low <= off <= high
    names = [n for n in names if any(cover[n])]
    t = (d - d.min()) / max(d.max() - d.min(), 1)
    cols = [np.ones_like(t), t]
    cols += [np.maximum(t - spec.changepoint_range * j / spec.changepoints, 0) for j in range(1, spec.changepoints + 1)]
    for period, order in ((7, spec.weekly_order), (365.25, spec.yearly_order)):
        for k in range(1, order + 1):
            cols += [np.sin(2 * np.pi * k * d / period), np.cos(2 * np.pi * k * d / period)]
    cols += [np.array(cover[n]) for n in names]
    x = np.stack(cols, 1)
    root = np.sqrt(spec.penalties(len(names)))
    beta = np.linalg.lstsq(np.vstack((x, np.diag(root))), np.concatenate((y, np.zeros(len(root)))), rcond=None)[0]
    return x @ beta, y, known


def test_many_series_equal_numpy_least_squares(spark):
    rng = np.random.default_rng(4)
    start, spec = dt.date(2014, 3, 1), demand.Spec()
    series = {}
    for k in range(1000):
        n = int(rng.integers(100, 160))
        y = 50 + k % 7 + np.cumsum(rng.normal(0, .3, n)) + 5 * np.sin(2 * np.pi * np.arange(n) / 7) + rng.normal(0, 1, n)
        series[f"s{k}"] = [None if rng.random() < 0.03 else float(v) for v in y]
    series["long"] = (100 + 8 * np.sin(2 * np.pi * np.arange(1500) / 365.25) + rng.normal(0, 1, 1500)).tolist()
    events = [("fair", dt.date(2014, 4, 1), -1, 2), ("feast", dt.date(2014, 4, 3), 0, 0), ("never", dt.date(1999, 1, 1), 0, 0)]
    fitted = make(spark, series, start, events, spec=spec)
    got = {}
    for r in demand.predict(fitted).where("not is_future").collect():
        got.setdefault(r.sid, []).append((r.date_id, r.yhat))
    assert len(got) == 1001
    for key in ["long", *list(series)[:1000:37]]:
        want, _, known = numpy_fit(series[key], start, events, spec)
        have = np.array([v for _, v in sorted(got[key])])[known]
        assert np.abs(have - want).max() < 1e-8 * np.abs(want).max()


def test_moments_of_stretches_add_up(spark, monkeypatch):
    rng = np.random.default_rng(1)
    series = {"a": (20 + np.arange(400) * .05 + rng.normal(0, 1, 400)).tolist()}
    whole = demand.predict(make(spark, series, events=SEVEN)).orderBy("date_id").collect()
    monkeypatch.setattr(demand, "STRETCH_DAYS", 45)
    fitted = make(spark, series, events=SEVEN)
    assert demand.moments(fitted["prepared"], ["sid"], fitted["spec"]).count() > 8
    parts = demand.predict(fitted).orderBy("date_id").collect()
    assert max(abs(a.yhat - b.yhat) for a, b in zip(whole, parts)) < 1e-8


def test_recovers_yearly_season_changepoint_and_events(spark):
    start = dt.date(2012, 1, 1)
    n = 4 * 365
    rng = np.random.default_rng(2)
    day = np.arange(n)
    base = 100 + 0.02 * day - 0.05 * np.maximum(day - 700, 0) + 9 * np.sin(2 * np.pi * (day - 3) / 365.25) + 4 * np.cos(2 * np.pi * day / 7)
    y = base + rng.normal(0, .5, n)
    fair = [("fair", start + dt.timedelta(days=200 + 365 * k), -1, 1) for k in range(5)]
    for _, ds, _, _ in fair[:4]:
        at = (ds - start).days
        y[at - 1:at + 2] += 30
    rows = demand.predict(make(spark, {"a": y.tolist()}, start, fair, horizon=60)).orderBy("date_id").collect()
    for r in rows[-60:]:
        i = (r.date_id - start).days
        want = 100 + 0.02 * i - 0.05 * (i - 700) + 9 * math.sin(2 * math.pi * (i - 3) / 365.25) + 4 * math.cos(2 * math.pi * i / 7)
        assert abs(r.yhat - r.holidays - want) < 1.5
    at = [r for r in rows if r.holidays]
    assert len(at) == 4 * 3 and all(abs(r.holidays - 30) < 1 for r in at)
    assert abs(np.mean([r.yearly for r in rows[:365]])) < 0.5


def test_straight_variant_recovers_seasonality(spark):
    start = dt.date(2017, 1, 2)
    y = [50 + 0.01 * i + 8 * math.sin(2 * math.pi * i / 365.25) + [0, 1, 2, 3, 9, 12, -2][i % 7] for i in range(3 * 365)]
    spec = demand.Spec(changepoints=0, yearly_order=3, season_penalty=1e-9)
    got = demand.predict(make(spark, {"a": y}, start, spec=spec, horizon=44), future_only=True).collect()
    assert len(got) == 44
    for r in got:
        i = (r.date_id - start).days
        assert abs(r.yhat - (50 + 0.01 * i + 8 * math.sin(2 * math.pi * i / 365.25) + [0, 1, 2, 3, 9, 12, -2][i % 7])) < 1e-5


def test_interval_covers_and_repeats(spark):
    rng = np.random.default_rng(8)
    n, horizon = 500, 30
    series, future = {}, {}
    for k in range(60):
        slope = np.zeros(n + horizon)
        for at in rng.integers(20, n, 6):
            slope[at:] += rng.laplace(0, .03)
        y = 100 + np.cumsum(slope) + 5 * np.sin(2 * np.pi * np.arange(n + horizon) / 7) + rng.normal(0, 2, n + horizon)
        series[f"s{k}"], future[f"s{k}"] = y[:n].tolist(), y[n:]
    fitted = make(spark, series, horizon=horizon, spec=demand.Spec(yearly_order=0))
    once = demand.forecast(fitted, paths=200, seed=3, future_only=True).orderBy("sid", "date_id").collect()
    again = demand.forecast(fitted, paths=200, seed=3, future_only=True).orderBy("sid", "date_id").collect()
    assert once == again
    inside = [r.yhat_lower <= v <= r.yhat_upper for key in sorted(series)
              for r, v in zip([r for r in once if r.sid == key], future[key])]
    assert 0.78 < np.mean(inside) < 0.97
    wide = {}
    for i, r in enumerate(once):
        wide.setdefault(i % horizon, []).append(r.yhat_upper - r.yhat_lower)
    assert np.mean(wide[horizon - 1]) > np.mean(wide[0])          # trend uncertainty grows
    one = make(spark, {"s7": series["s7"]}, horizon=horizon, spec=demand.Spec(yearly_order=0))
    alone = demand.forecast(one, paths=200, seed=3, future_only=True).orderBy("date_id").collect()
    same = [r for r in once if r.sid == "s7"]
    assert [(round(r.yhat_lower, 6), round(r.yhat_upper, 6)) for r in alone] == [
        (round(r.yhat_lower, 6), round(r.yhat_upper, 6)) for r in same]


def test_interval_equals_a_loop_over_paths(spark):
    import hashlib
    fitted = make(spark, {"a": [10 + (i % 5) + 0.1 * i for i in range(90)]}, horizon=6)
    rows = demand.intervals(demand.predict(fitted, True), ["sid"], paths=40, seed=9).orderBy("day").collect()
    values = {r.day: [] for r in rows}
    for path in range(40):
        changes = []
        for r in rows:
            h = hashlib.md5(f"9|a|{path}|{r.day}".encode()).hexdigest()
            u = [(int(h[8 * k:8 * k + 8], 16) + 0.5) / 2 ** 32 for k in range(4)]
            size = -r.change_size * math.copysign(1, u[1] - .5) * math.log(1 - 2 * abs(u[1] - .5))
            changes.append((r.day, size if u[0] < r.change_rate else 0.0))
            bend = sum(c * (r.day - at) for at, c in changes) / r.span
            noise = r.sigma * math.sqrt(-2 * math.log(u[2])) * math.cos(2 * math.pi * u[3])
            values[r.day].append(r.yhat + bend + noise)
    for r in rows:
        assert [r.yhat_lower, r.yhat_upper] == pytest.approx(np.quantile(values[r.day], [0.05, 0.95]).tolist(), abs=1e-9)


def test_degenerate_series(spark):
    fitted = make(spark, {"one": [5.0], "flat": [3.0] * 30, "none": [None] * 4, "two": [1.0, 2.0]}, horizon=3)
    rows = demand.forecast(fitted, paths=20).collect()
    assert {r.sid for r in rows} == {"one", "flat", "two"}
    assert all(abs(r.yhat - 5) < 1e-3 for r in rows if r.sid == "one")
    assert all(abs(r.yhat - 3) < 1e-3 and abs(r.yhat_upper - 3) < 1e-2 for r in rows if r.sid == "flat")
    assert all(math.isfinite(r.yhat_lower) for r in rows)


def test_reference_event_rows_and_overlapping_windows(spark):
    days = demand.event_days(spark.createDataFrame(SEVEN, EVENTS)).collect()
    assert len(days) == 8 and {(r.holiday, r.day_offset) for r in days if r.date_id == dt.date(2015, 12, 24)} == {("Christmas", -1)}
    rules = demand.dated_events(spark.createDataFrame([(dt.date(2015, 5, 1), dt.date(2015, 6, 1))], "min_date date, max_date date"),
                                forecast.HOLIDAYS).collect()
    assert sorted(map(tuple, rules)) == sorted(SEVEN)
    odd = [("a", dt.date(2020, 1, 10), -2, 1), ("b", dt.date(2020, 1, 9), 0, 3), ("empty", dt.date(2020, 1, 9), 1, 0),
           ("undated", None, 0, 0), ("a", dt.date(2020, 1, 11), 0, 0)]
    calendar = spark.createDataFrame([(dt.date(2020, 1, d),) for d in (9, 9, 10, 11, 20)], "date_id date")
    got = sorted((r.holiday, r.date_id.day) for r in demand.event_days(spark.createDataFrame(odd, EVENTS), calendar).collect())
    assert got == [("a", 9), ("a", 10), ("a", 11), ("a", 11), ("b", 9), ("b", 10), ("b", 11)]
    base = [10.0] * 40
    base[8:12] = [17.0, 17.0, 12.0, 10.0]                        # a adds 5 on 9 to 11 January, b 2 on 9 and 10
    base[10] = 15.0
    events = [("a", dt.date(2020, 1, 9), 0, 2), ("b", dt.date(2020, 1, 9), 0, 1)]
    rows = demand.predict(make(spark, {"x": base}, dt.date(2020, 1, 1), events,
                               spec=demand.Spec(changepoints=0, weekly_order=0, yearly_order=0))).collect()
    hol = {r.date_id.day: r.holidays for r in rows if not r.is_future and r.date_id.month == 1}
    assert hol[9] == pytest.approx(7, abs=1e-3) and hol[11] == pytest.approx(5, abs=1e-3) and hol[12] == 0


def test_fit_deals_rows_by_series_once(spark):
    start = dt.date(2020, 1, 1)
    df = spark.createDataFrame([("a", start, 1.0)], "sid string, date_id date, y double")
    days = demand.event_days(spark.createDataFrame(SEVEN, EVENTS))
    frame = df.withColumn("is_future", F.lit(False))
    model = demand.fit(frame, F.broadcast(days), keys=["sid"])["model"]
    plan = model._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(([^,]*),", plan)
    assert len([d for d in dealt if d.startswith("sid")]) == 2      # the rows once, their moment rows once
    assert "_stretch" not in "".join(dealt)
    assert "BatchEvalPython" not in plan
