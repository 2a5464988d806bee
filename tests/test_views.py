"""Views (M17-M21) keep the inner joins' meaning on a damaged warehouse."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.operators import anomaly, clean, metrics, star, validate, views

DAY = dt.date(2026, 7, 21)


def test_kpi_counts_only_rows_with_dimension_members(spark, raw_frame):
    rows = [("1", "A", "X", "2", "01/12/2010 08:00", "1.0", "5", "UK"),
            ("2", "B", "Y", "3", "02/12/2010 08:00", "1.0", None, "France"),
            ("3", "C", "Z", "4", "03/12/2010 08:00", "1.0", "6", "Spain")]
    labelled = validate.label_rows(raw_frame(rows), DAY)
    s = star.build_star_schema(clean.clean_transactions(validate.accepted_rows(labelled)))
    flags = anomaly.detect_anomalies(metrics.daily_metrics(s["fact_sales"], s["dim_date"], s["dim_region"]))
    full = views.kpi_summary(s["fact_sales"], s["dim_date"], s["dim_customer"], flags).first()
    assert (full.order_count, full.customer_count, full.units_sold) == (3, 2, 9)
    # drop customer 6 and the first day from the dimensions: their rows no longer count
    customers = s["dim_customer"].where(F.col("customer_id") != "6")
    dates = s["dim_date"].where(F.col("day_of_month") != 1)
    kpi = views.kpi_summary(s["fact_sales"], dates, customers, flags).first()
    assert (kpi.order_count, kpi.customer_count, kpi.units_sold) == (1, 0, 3)
    assert kpi.earliest_sales_date == kpi.latest_sales_date == dt.date(2010, 12, 2)
