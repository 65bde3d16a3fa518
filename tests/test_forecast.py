"""Forecast model, holiday rules and the staffing arithmetic."""

import datetime as dt

import numpy as np

from tallystar.operators import forecast

# The reference's committed staffing report (forecast_upper,
# forecast_peak_hour_orders, staff_needed) for 2016-01-01 .. 2016-01-30.
GOLDEN = [(73, 7, 1), (63, 6, 1), (53, 5, 1), (61, 6, 1), (59, 6, 1), (59, 6, 1), (62, 6, 1),
          (70, 7, 1), (60, 6, 1), (51, 5, 1), (57, 5, 1), (56, 5, 1), (57, 5, 1), (60, 6, 1),
          (68, 6, 1), (60, 6, 1), (50, 5, 1), (57, 5, 1), (57, 5, 1), (59, 6, 1), (60, 6, 1),
          (70, 7, 1), (61, 6, 1), (50, 5, 1), (59, 6, 1), (59, 6, 1), (60, 6, 1), (62, 6, 1),
          (70, 7, 1), (62, 6, 1)]


def test_staffing_reproduces_golden_report(spark):
    start = dt.date(2016, 1, 1)
    rows = [(start + dt.timedelta(days=i), float(u), float(u) - 10, float(u)) for i, (u, _, _) in
            enumerate(GOLDEN)]
    fc = spark.createDataFrame(rows, "date_id date, yhat double, yhat_lower double, yhat_upper double")
    got = forecast.staffing(fc).orderBy("date_id").collect()
    assert [(int(r.yhat_upper), int(r.peak_hour_orders), r.staff_needed) for r in got] == GOLDEN
    assert got[0].day_name == "Friday"
    rep = forecast.report(forecast.staffing(fc)).columns
    assert rep == ["date", "day_name", "forecast_orders", "forecast_lower", "forecast_upper",
                   "forecast_peak_hour_orders", "staff_needed"]


def test_holiday_rules_give_reference_2015_dates(spark):
    bounds = spark.createDataFrame([(dt.date(2015, 1, 1), dt.date(2015, 12, 31))],
                                   "min_date date, max_date date")
    got = {(r.holiday, r.date_id) for r in forecast.holiday_calendar(bounds).collect()}
    want = {("New Year", dt.date(2015, 1, 1)), ("Valentine's Day", dt.date(2015, 2, 14)),
            ("Independence Day", dt.date(2015, 7, 4)), ("Thanksgiving", dt.date(2015, 11, 26)),
            ("Black Friday", dt.date(2015, 11, 27)), ("Christmas", dt.date(2015, 12, 24)),
            ("Christmas", dt.date(2015, 12, 25)), ("Boxing Day", dt.date(2015, 12, 26))}
    assert got == want


def test_fit_recovers_trend_and_weekday_effects(spark):
    start = dt.date(2019, 1, 7)   # a Monday
    eff = [5.0, 0.0, 1.0, 2.0, 9.0, 12.0, -4.0]
    rows = [(start + dt.timedelta(days=i), 40.0 + 0.1 * i + eff[i % 7]) for i in range(140)]
    ser = spark.createDataFrame(rows, "date_id date, y double")
    hol = forecast.holiday_calendar(forecast.holiday_bounds(ser, 30))
    train = forecast.training_window(ser, 14)
    assert train.count() == 126
    model = forecast.fit(forecast.future_frame(train, 44, value="y"), hol)
    t = model["trend"].first()
    assert abs(t.b - 0.1) < 1e-3
    wk = {r.day_name: r.effect for r in model["weekday"].collect()}
    centred = np.array(eff) - np.mean(eff)
    assert abs((wk["Saturday"] - wk["Tuesday"]) - (centred[5] - centred[1])) < 0.2
    pred = forecast.predict(model)
    fc = forecast.forecast_rows(pred, ser).orderBy("date_id").collect()
    assert len(fc) == 30
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in fc)


def test_peak_ratio(spark):
    hourly = spark.createDataFrame([(11, 20), (12, 50), (13, 50), (14, 30)], "hour int, total_orders long")
    r = forecast.peak_ratio(hourly).first()
    assert (r.peak_hour, r.peak_orders, r.all_orders, r.peak_ratio) == (12, 50, 150, 0.3333)
