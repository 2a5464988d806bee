"""Anomaly detection that starts at the first changed day equals a
recomputation of all days."""

import datetime as dt
import random

import pytest

from tillroll.operators import anomaly
from tillroll.operators.warehouse import Warehouse
from tillroll.plans.daily_run import run_anomaly_detection

DAY = dt.date(2010, 12, 20)
SCHEMA = "metric_date date, region_key string, region_name string, revenue decimal(20,2), returns decimal(20,2)"


def frame(spark, state, until=None):
    rows = [(DAY + dt.timedelta(d), r, r.upper(), v, w) for (d, r), (v, w) in sorted(state.items())
            if until is None or d <= until]
    return spark.createDataFrame(rows, SCHEMA)


def history(r, days=30):
    return {(d, k): (r.randint(0, 99999) / 100 * 1, r.randint(0, 900) / 100) for d in range(days) for k in ("uk", "eu")
            if r.random() < 0.9}


def as_decimal(state):
    from decimal import Decimal

    return {k: tuple(Decimal(str(round(x, 2))) for x in v) for k, v in state.items()}


def flags(df):
    return sorted(tuple(str(x) for x in r) for r in df.drop("detected_at").collect())


def test_restart_equals_whole(spark, tmp_path):
    r = random.Random(8)
    state = as_decimal(history(r))
    steps = [(dict(state), None, {})]
    state[(30, "uk")] = as_decimal({0: (9000.0, 1.0)})[0]  # a new day
    steps.append((dict(state), None, {}))
    state[(9, "uk")] = as_decimal({0: (5000.0, 80.0)})[0]  # a late batch, over the turn of the year
    steps.append((dict(state), None, {}))
    steps.append((dict(state), None, {}))  # nothing new
    for key in ((12, "uk"), (12, "eu"), (20, "eu")):  # a shrinking rerun: days go
        state.pop(key, None)
    steps.append((dict(state), None, {}))
    state[(5, "eu")] = as_decimal({0: (7000.0, 0.0)})[0]
    steps.append((dict(state), 8, {}))  # a bounded run leaves later days
    steps.append((dict(state), None, {}))
    steps.append((dict(state), None, {"window": 4, "min_periods": 2}))  # other parameters
    for key in [k for k in state if k[0] >= 28]:
        del state[key]  # the last days go: their flags stay, as ever
    steps.append((dict(state), None, {"window": 4, "min_periods": 2}))
    for step, (now, until, params) in enumerate(steps):
        daily = frame(spark, now, until)
        got = run_anomaly_detection(spark, f"{tmp_path}/restart", daily=daily, **params)
        want = run_anomaly_detection(spark, f"{tmp_path}/whole", daily=daily, whole=True, **params)
        assert flags(got) == flags(want), step


def test_only_days_from_the_change_are_worked_out(spark, tmp_path):
    state = as_decimal(history(random.Random(3)))
    run_anomaly_detection(spark, str(tmp_path), daily=frame(spark, state))
    before = {(r.metric_date, r.region_key): r.detected_at for r in Warehouse(spark, f"{tmp_path}/warehouse").read(
        "anomaly_flags").collect()}
    changed = min(d for d, k in state if d >= 21 and k == "uk")
    state[(changed, "uk")] = as_decimal({0: (1.0, 1.0)})[0]
    after = run_anomaly_detection(spark, str(tmp_path), daily=frame(spark, state)).collect()
    for r in after:
        same = r.detected_at == before[(r.metric_date, r.region_key)]
        assert same == (r.metric_date < DAY + dt.timedelta(changed))


def test_a_run_that_stopped_is_done_whole(spark, tmp_path, monkeypatch):
    state = as_decimal(history(random.Random(4)))
    run_anomaly_detection(spark, str(tmp_path), daily=frame(spark, state))
    state[(9, "uk")] = as_decimal({0: (8000.0, 1.0)})[0]

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m, pytest.raises(RuntimeError):
        m.setattr(Warehouse, "persist_anomalies", stop)
        run_anomaly_detection(spark, str(tmp_path), daily=frame(spark, state))
    assert Warehouse(spark, f"{tmp_path}/warehouse").anomaly_note() is None
    got = run_anomaly_detection(spark, str(tmp_path), daily=frame(spark, state))
    assert flags(got.select(*anomaly.detect_anomalies(frame(spark, state)).columns)) == flags(
        anomaly.detect_anomalies(frame(spark, state)))


def test_empty_metrics_and_no_change(spark, tmp_path):
    empty = frame(spark, {})
    assert run_anomaly_detection(spark, str(tmp_path), daily=empty).count() == 0
    daily = frame(spark, as_decimal(history(random.Random(5))))
    found = anomaly.detect_anomalies(daily)
    assert anomaly.first_changed_day(found, daily).first()[0] is None
    assert anomaly.first_changed_day(found, empty).first()[0] is None
    assert anomaly.detect_anomalies_since(daily, None).count() == 0
