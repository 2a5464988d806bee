"""Idempotent loads (W1-W4) on Parquet: reruns, first write wins, shrinking
rerun, empty batch, range and run replacement."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.operators import clean, star, validate, warehouse
from tillroll.operators.warehouse import Warehouse

D1, D2 = dt.date(2026, 7, 21), dt.date(2026, 7, 22)


def rows(n, start=0, country="UK"):
    return [(str(10000 + i), f"S{i % 3}", f"ITEM {i % 3}", "1", "01/12/2010 08:26", "2.0", str(i % 2 + 1), country)
            for i in range(start, start + n)]


def star_of(raw_frame, data, day):
    labelled = validate.label_rows(raw_frame(data), day)
    # Cleaned once, as the daily run does: a load reads its batch several times.
    cleaned = clean.clean_transactions(validate.accepted_rows(labelled)).checkpoint()
    return star.build_star_schema(cleaned, check_empty=False)


def fact_ids(wh, day=None):
    df = wh.read("fact_sales")
    if day is not None:
        df = df.where(F.col("ingestion_date") == F.lit(day))
    return sorted(r.transaction_id for r in df.select("transaction_id").collect())


def test_rerun_same_date_is_idempotent(spark, raw_frame, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    s = star_of(raw_frame, rows(6), D1)
    wh.load_star(s, D1)
    first = fact_ids(wh)
    wh.load_star(s, D1)
    assert fact_ids(wh) == first and len(first) == 6
    assert wh.read("dim_product").count() == 3


def test_first_write_wins_and_shrinking_rerun(spark, raw_frame, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.load_star(star_of(raw_frame, rows(6), D1), D1)              # A: 0..5
    wh.load_star(star_of(raw_frame, rows(6, start=3), D2), D2)     # B: 3..8, 3..5 already held by A
    assert len(fact_ids(wh, D1)) == 6 and len(fact_ids(wh, D2)) == 3
    wh.load_star(star_of(raw_frame, rows(2), D1), D1)  # A rerun with 0..1 only
    assert len(fact_ids(wh, D1)) == 2
    assert len(fact_ids(wh, D2)) == 3  # Q12: 2..5 are gone until B is rerun
    wh.load_star(star_of(raw_frame, rows(6, start=3), D2), D2)
    assert len(fact_ids(wh, D2)) == 6


def test_empty_batch_clears_its_partition(spark, raw_frame, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.load_star(star_of(raw_frame, rows(4), D1), D1)
    wh.load_star(star_of(raw_frame, rows(3, start=100), D2), D2)
    empty = star_of(raw_frame, [r[:3] + ("0",) + r[4:] for r in rows(2)], D1)  # zero quantity: nothing left
    wh.load_star(empty, D1)
    assert fact_ids(wh, D1) == []
    assert len(fact_ids(wh, D2)) == 3


def test_dimensions_keep_existing_attributes(spark, raw_frame, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.load_star(star_of(raw_frame, rows(3), D1), D1)
    changed = [r[:2] + ("RENAMED",) + r[3:] for r in rows(3)]
    wh.load_star(star_of(raw_frame, changed, D2), D2)
    assert {r.description for r in wh.read("dim_product").collect()} == {"ITEM 0", "ITEM 1", "ITEM 2"}


def _flags(spark, days, value):
    data = [(d, "r1", "One", value, 0.0, None, None, None, None, False, "none", 0.0, "normal") for d in days]
    return spark.createDataFrame(
        data, "metric_date date, region_key string, region_name string, revenue double, returns double, "
        "revenue_baseline double, returns_baseline double, revenue_zscore double, returns_zscore double, "
        "is_anomaly boolean, anomaly_type string, severity_score double, severity string")


def test_anomaly_range_replace(spark, tmp_path):
    days = [dt.date(2026, 1, i) for i in range(1, 11)]
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.persist_anomalies(_flags(spark, days, 1.0))
    wh.persist_anomalies(_flags(spark, days[3:6], 2.0))
    got = {r.metric_date: float(r.revenue) for r in wh.read("anomaly_flags").collect()}
    assert len(got) == 10
    assert [got[d] for d in days] == [1.0] * 3 + [2.0] * 3 + [1.0] * 4
    wh.persist_anomalies(_flags(spark, [], 3.0))  # empty: no-op
    assert wh.read("anomaly_flags").count() == 10


def _fc(spark, run, value, regions=("r1",)):
    data = [(run, run + dt.timedelta(days=k), r, r.upper(), 7, value, "simple_exponential_smoothing")
            for r in regions for k in range(1, 8)]
    return spark.createDataFrame(data, "forecast_run_date date, forecast_date date, region_key string, "
                                 "region_name string, horizon_days int, forecast_revenue double, model_name string")


def test_forecast_run_replace(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    r1, r2 = dt.date(2026, 1, 1), dt.date(2026, 1, 2)
    wh.persist_forecasts(_fc(spark, r1, 1.0, ("a", "b")), r1)
    wh.persist_forecasts(_fc(spark, r2, 2.0), r2)
    wh.persist_forecasts(_fc(spark, r1, 3.0, ("a",)), r1)  # rerun r1 with fewer regions
    got = wh.read("revenue_forecasts")
    assert got.where(F.col("forecast_run_date") == r1).count() == 7
    assert {float(r.forecast_revenue) for r in got.where(F.col("forecast_run_date") == r1).collect()} == {3.0}
    assert got.where(F.col("forecast_run_date") == r2).count() == 7


def test_pure_merge_rules(spark, raw_frame):
    a = star_of(raw_frame, rows(4), D1)["fact_sales"]
    b = star_of(raw_frame, rows(4, start=2), D2)["fact_sales"]
    state = warehouse.load_fact(warehouse.load_fact(None, a, D1), b, D2)
    assert state.count() == 6
    assert state.where(F.col("ingestion_date") == D2).count() == 2


def test_anomaly_years_are_replaced_in_place(spark, tmp_path):
    import os
    wh = Warehouse(spark, str(tmp_path / "wh"))
    days = [dt.date(y, m, 1) for y in (2024, 2025, 2026) for m in (1, 6)]
    wh.persist_anomalies(_flags(spark, days, 1.0))
    assert sorted(os.listdir(tmp_path / "wh" / "anomaly_flags"))[-3:] == [
        "metric_year=2024", "metric_year=2025", "metric_year=2026"]
    # a batch covering 2024-06 .. 2026-01 with no 2025 rows empties 2025
    wh.persist_anomalies(_flags(spark, [dt.date(2024, 6, 1), dt.date(2026, 1, 1)], 5.0))
    got = {r.metric_date: float(r.revenue) for r in wh.read("anomaly_flags").collect()}
    assert got == {dt.date(2024, 1, 1): 1.0, dt.date(2024, 6, 1): 5.0,
                   dt.date(2026, 1, 1): 5.0, dt.date(2026, 6, 1): 1.0}
    assert "metric_year" not in wh.read("anomaly_flags").columns
