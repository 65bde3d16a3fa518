"""Loess decomposition against a plain NumPy one, many series at once."""

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallystar.operators import series, stl


def loess(y, w, q):
    n, out = len(y), []
    for i in range(n):
        left = max(0, min(i - q // 2, n - q))
        right = min(n - 1, left + q - 1)
        h = max(i - left, right - i) + ((q - n) // 2 if q > n else 0)
        j = np.arange(left, right + 1)
        r = np.abs(j - i)
        k = np.where(r > .999 * h, 0, np.where(r <= .001 * h, 1, (1 - (r / max(h, 1e-300)) ** 3) ** 3)) * w[j]
        if k.sum() <= 0:
            out.append(y[i])
            continue
        k = k / k.sum()
        a = (k * j).sum()
        c = (k * (j - a) ** 2).sum()
        if np.sqrt(c) > .001 * (n - 1):
            k = k * ((i - a) / c * (j - a) + 1)
        out.append((k * y[j]).sum())
    return np.array(out)


def numpy_stl(y, robust, q=11, period=7):
    y = np.asarray(y, float)
    place, w, trend = np.arange(len(y)) % period, np.ones(len(y)), np.zeros(len(y))
    rounds = 16 if robust else 2
    for at in range(rounds):
        flat = y - trend
        c = np.array([(w * flat)[place == p].sum() / w[place == p].sum() if w[place == p].sum() > 0 else flat[place == p].mean()
                      for p in range(min(period, len(y)))])
        seasonal = (c - c.mean())[place]
        trend = loess(y - seasonal, w, q)
        if robust and at < rounds - 1:
            r = np.round(np.abs(y - seasonal - trend), 9)
            h = 6 * np.median(r)
            w = np.where(r <= .001 * h, 1, np.where(r <= .999 * h, (1 - (r / max(h, 1e-300)) ** 2) ** 2, 0))
    return trend, seasonal


def frame(spark, values):
    start = dt.date(1992, 1, 1)
    rows = [(k, start + dt.timedelta(days=i), float(v)) for k, own in values.items() for i, v in enumerate(own)]
    return spark.createDataFrame(rows, "sid string, date_id date, y double")


@pytest.mark.parametrize("robust", [False, True])
def test_equals_numpy_on_many_series(spark, robust):
    rng = np.random.default_rng(6)
    week = np.array([0, 1, 5, 2, 8, 11, -3.0])

    def make(n):
        y = 50 + np.cumsum(rng.normal(0, .4, n)) + week[np.arange(n) % 7] + rng.normal(0, 1.5, n)
        y[rng.random(n) < .02] += 40
        return y

    values = {"whole": make(2405), **{f"s{k}": make(int(rng.integers(12, 90))) for k in range(40)},
              "short": make(5), "one": make(1), "flat": np.full(30, 4.0), "week": np.tile(week, 6)}
    got = {}
    for r in stl.stl(frame(spark, values), "y", robust=robust, keys=["sid"], digits=None).collect():
        got.setdefault(r.sid, []).append((r.date_id, r.trend, r.seasonal, r.remainder, r.observed))
    assert {k: len(v) for k, v in got.items()} == {k: len(v) for k, v in values.items()}
    for key, own in got.items():
        own = np.array([x[1:] for x in sorted(own)])
        trend, seasonal = numpy_stl(values[key], robust)
        assert np.abs(own[:, 0] - trend).max() < 1e-7 and np.abs(own[:, 1] - seasonal).max() < 1e-7, key
        assert np.abs(own[:, :3].sum(1) - own[:, 3]).max() < 1e-9


def test_robust_rounds_ignore_an_outlier(spark):
    week = np.array([0, 1, 5, 2, 8, 11, 3.0])
    y = 30 + week[np.arange(140) % 7]
    y[70] += 500
    rows = stl.stl(frame(spark, {"a": y}), "y", robust=True, keys=["sid"]).orderBy("date_id").collect()
    assert abs(rows[70].remainder - 500) < 0.01
    assert max(abs(r.remainder) for i, r in enumerate(rows) if i != 70) < 0.01


def test_null_days_take_no_part(spark):
    y = [float(20 + i % 7) for i in range(63)]
    df = frame(spark, {"a": y}).withColumn("y", F.when(F.dayofmonth("date_id") != 9, F.col("y")))
    rows = stl.stl(df, "y", keys=["sid"], robust=True).collect()
    assert len(rows) == 63
    for r in rows:
        assert (r.remainder is None) == (r.date_id.day == 9)
        assert abs(r.trend - 23) < 1e-3
    assert stl.stl(df.limit(0), "y", keys=["sid"]).count() == 0


def test_a_job_of_rounds_shuffles_once(spark):
    plan = stl.stl(frame(spark, {"a": range(30)}), "y", keys=["sid"])._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall("Exchange ", plan)) == 1 and "Python" not in plan


def test_trend_window_of_a_week():
    assert stl.trend_window(7, 10 ** 6) == 11 and stl.trend_window(12, 7) == 23


def test_feeds_the_reports(spark):
    y = [float(20 + i % 7 + i / 10) for i in range(60)]
    out = stl.stl(frame(spark, {"a": y}).drop("sid"), "y")
    long = series.decompose_long(series.trim_tail(out, "trend", 21))
    assert long.count() == 240 and long.where("value is null").count() == 21
    assert {r.component for r in series.decompose_summary(out).collect()} == {"observed", "trend", "seasonal", "remainder"}
