"""Anomalies (M13) and forecasts (M15): reference fixture 1.3, Q13-Q18."""

import datetime as dt

import pytest

from tillroll.operators import anomaly, forecast


def daily(spark, revenue, returns=None, start=dt.date(2026, 7, 1), region=("region_uk", "United Kingdom"), gaps=None):
    returns = returns or [0] * len(revenue)
    days = gaps or [start + dt.timedelta(days=i) for i in range(len(revenue))]
    rows = [(d, region[0], region[1], float(r) if r is not None else None, float(t)) for d, r, t in zip(days, revenue, returns)]
    return spark.createDataFrame(rows, "metric_date date, region_key string, region_name string, revenue double, returns double")


def test_spike_flagged(spark):
    df = daily(spark, [210, 195, 205, 220, 190, 200, 208, 1900], [5, 4, 6, 5, 4, 5, 6, 80])
    flags = anomaly.detect_anomalies(df, window=5, min_periods=3, z_threshold=3.0).orderBy("metric_date").collect()
    last = flags[-1]
    assert last.is_anomaly
    assert last.anomaly_type == "revenue_and_returns"
    assert float(last.severity_score) >= 3.0
    assert last.severity == "high"
    assert flags[0].revenue_baseline is None and flags[2].revenue_baseline is None  # min_periods
    assert flags[3].revenue_baseline is not None
    assert len(flags) == 8  # every region-day is returned


def test_flat_then_jump_is_not_flagged(spark):
    df = daily(spark, [100] * 7 + [1000])
    last = anomaly.detect_anomalies(df).orderBy("metric_date").collect()[-1]
    assert last.revenue_zscore is None  # Q14: zero deviation gives no z-score
    assert not last.is_anomaly and last.severity == "normal" and float(last.severity_score) == 0.0


def test_window_counts_rows_not_days(spark):
    days = [dt.date(2026, 1, 1), dt.date(2026, 2, 1), dt.date(2026, 3, 1), dt.date(2026, 3, 2)]
    flags = anomaly.detect_anomalies(daily(spark, [1, 2, 3, 4], gaps=days), window=3, min_periods=3)
    last = flags.orderBy("metric_date").collect()[-1]
    assert float(last.revenue_baseline) == 2.0  # Q13: three prior rows, a month apart


def test_parameter_errors(spark):
    df = daily(spark, [1, 2, 3])
    with pytest.raises(ValueError):
        anomaly.detect_anomalies(df, window=1)
    with pytest.raises(ValueError):
        anomaly.detect_anomalies(df, window=3, min_periods=5)
    with pytest.raises(ValueError):
        anomaly.detect_anomalies(df, z_threshold=4.0)
    with pytest.raises(ValueError):
        forecast.forecast_revenue(df, horizons=())
    with pytest.raises(ValueError):
        forecast.forecast_revenue(df, horizons=(7, 0))


def test_forecast_horizons(spark):
    df = daily(spark, [100, 110, 90, 105, 95, 100, 102, 1000])
    rows = forecast.forecast_revenue(df, run_date=dt.date(2026, 7, 8)).collect()
    assert {r.horizon_days for r in rows} == {7, 30}
    assert sum(r.horizon_days == 7 for r in rows) == 7
    assert sum(r.horizon_days == 30 for r in rows) == 30
    assert all(float(r.forecast_revenue) >= 0 for r in rows)
    assert all(r.model_name == "simple_exponential_smoothing" for r in rows)
    assert min(r.forecast_date for r in rows) == dt.date(2026, 7, 9)


def recursion(values):
    alpha = min(1.0, max(0.01, 2.0 / (len(values) + 1)))
    level = values[0]
    for v in values[1:]:
        level = alpha * v + (1 - alpha) * level
    return level


def test_closed_form_matches_recursion_with_gaps(spark):
    days = [dt.date(2026, 1, 1), dt.date(2026, 1, 2), dt.date(2026, 1, 5), dt.date(2026, 1, 9)]
    revenue = [120.0, None, 80.0, 300.0]
    df = daily(spark, revenue, gaps=days)
    level = forecast.smoothing_levels(df).first().level
    filled = [120.0, 0.0, 0.0, 0.0, 80.0, 0.0, 0.0, 0.0, 300.0]  # zero-filled calendar
    assert abs(level - recursion(filled)) < 1e-9


def test_single_day_series_and_regional_start(spark):
    a = daily(spark, [50.0], region=("r1", "One"), start=dt.date(2026, 1, 1))
    b = daily(spark, [10.0, 20.0], region=("r2", "Two"), start=dt.date(2026, 1, 5))
    rows = forecast.forecast_revenue(a.unionByName(b), horizons=(2,)).collect()
    one = sorted((r.forecast_date, float(r.forecast_revenue), r.forecast_run_date) for r in rows if r.region_key == "r1")
    assert one == [(dt.date(2026, 1, 2), 50.0, dt.date(2026, 1, 1)), (dt.date(2026, 1, 3), 50.0, dt.date(2026, 1, 1))]
    two = [r for r in rows if r.region_key == "r2"]
    assert min(r.forecast_date for r in two) == dt.date(2026, 1, 7)  # Q17: after its own last day
    assert all(r.forecast_run_date == dt.date(2026, 1, 6) for r in two)  # Q18


def test_non_numeric_and_nan_revenue_count_as_zero(spark):
    rows = [(dt.date(2026, 1, d), "r", "R", v, "1") for d, v in
            [(1, "10"), (2, "abc"), (3, "NaN"), (4, None), (5, "30")]]
    df = spark.createDataFrame(rows, "metric_date date, region_key string, region_name string, revenue string, returns string")
    flags = anomaly.detect_anomalies(df, window=4, min_periods=3).orderBy("metric_date").collect()
    assert [float(r.revenue) for r in flags] == [10.0, 0.0, 0.0, 0.0, 30.0]
    assert float(flags[-1].revenue_baseline) == 2.5  # (10 + 0 + 0 + 0) / 4
    levels = forecast.smoothing_levels(df).first()
    assert levels.n_days == 5 and levels.level == levels.level  # no NaN
    nan_df = daily(spark, [float("nan"), 5.0])
    assert forecast.smoothing_levels(nan_df).first().level == 5.0 * (2.0 / 3.0)
