"""Gap filling and decomposition properties."""

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tallystar.operators import series


def _daily(spark, days, values):
    return spark.createDataFrame([(d, v) for d, v in zip(days, values)], "date_id date, total_orders long")


def test_gap_fill_length_and_weekday_median(spark):
    start = dt.date(2015, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(60) if i not in (10, 17, 30)]
    vals = [50 + (d.weekday() * 3) + (i % 4) for i, d in enumerate(days)]
    s = _daily(spark, days, vals)
    filled = series.gap_fill(s).toPandas()
    assert len(filled) == 60                      # max - min + 1
    assert filled["is_imputed"].sum() == 3
    obs = pd.DataFrame({"d": days, "v": vals})
    obs["dow"] = [d.weekday() for d in days]
    for _, r in filled[filled.is_imputed].iterrows():
        med = obs[obs.dow == r.date_id.weekday()]["v"].median()
        assert r.total_orders == int(np.round(med))   # numpy rounds half to even, like R
    missing = series.missing_days(s).toPandas()
    assert sorted(missing.date_id) == [start + dt.timedelta(days=i) for i in (10, 17, 30)]


def test_decompose_identity_and_centred_seasonal(spark):
    start = dt.date(2020, 3, 2)
    days = [start + dt.timedelta(days=i) for i in range(84)]
    rng = np.random.default_rng(1)
    vals = [int(40 + i * 0.2 + [0, 2, 4, 1, 9, 12, -3][i % 7] + rng.integers(0, 3)) for i in range(84)]
    out = series.decompose(_daily(spark, days, vals), digits=9).toPandas()
    resid = out.observed - out.trend - out.seasonal - out.remainder
    assert np.abs(resid).max() < 1e-6
    per_pos = out.groupby([(d - start).days % 7 for d in out.date_id])["seasonal"].first()
    assert abs(per_pos.sum()) < 1e-6
    # Centred 7-day mean in the interior.
    assert abs(out.trend[10] - np.mean(vals[7:14])) < 1e-6


def _robust_brute(y, iters, period=7):
    n = len(y)
    y = np.asarray(y, float)
    w = np.ones(n)
    pos = np.arange(n) % period

    def comp(w):
        trend = np.empty(n)
        for i in range(n):
            lo, hi = max(0, i - period // 2), min(n, i + period // 2 + 1)
            ws = w[lo:hi].sum()
            trend[i] = (w[lo:hi] * y[lo:hi]).sum() / ws if ws > 0 else y[lo:hi].mean()
        det = y - trend
        s = np.empty(period)
        for p in range(period):
            m = pos == p
            s[p] = (w[m] * det[m]).sum() / w[m].sum() if w[m].sum() > 0 else det[m].mean()
        s -= s.mean()
        return trend, s[pos], y - trend - s[pos]

    trend, seas, rem = comp(w)
    for _ in range(iters):
        h = 6 * np.median(np.abs(rem))
        u = np.abs(rem) / h
        w = np.where(u < 1, (1 - u * u) ** 2, 0.0) if h > 0 else np.ones(n)
        trend, seas, rem = comp(w)
    return trend, seas, rem


def test_robust_decompose_matches_numpy(spark):
    start = dt.date(2021, 1, 4)
    rng = np.random.default_rng(7)
    vals = [int(30 + [0, 1, 5, 2, 8, 11, 3][i % 7] + rng.integers(0, 4)) for i in range(70)]
    vals[20] += 80          # an outlier the robust rounds should down-weight
    days = [start + dt.timedelta(days=i) for i in range(70)]
    out = series.decompose(_daily(spark, days, vals), robust_iters=2, digits=9).toPandas()
    trend, seas, rem = _robust_brute(vals, 2)
    assert np.allclose(out.trend, trend, atol=1e-6)
    assert np.allclose(out.seasonal, seas, atol=1e-6)
    assert np.allclose(out.remainder, rem, atol=1e-6)


def test_series_keys_run_independently(spark):
    start = dt.date(2022, 1, 1)
    rows = [(k, start + dt.timedelta(days=i), 10 * k + i % 7) for k in (1, 2) for i in range(28)
            if not (k == 2 and i == 5)]
    s = spark.createDataFrame(rows, "sid int, date_id date, total_orders long")
    filled = series.gap_fill(s, keys=["sid"])
    assert filled.groupBy("sid").count().orderBy("sid").collect()[1]["count"] == 28
    dec = series.decompose(filled, keys=["sid"])
    assert dec.filter(F.col("sid") == 1).count() == 28
