"""The reporting views over a stored warehouse, as temp views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import views
from tillroll.operators.warehouse import Warehouse

TABLES = ("fact_sales", "dim_product", "dim_customer", "dim_date", "dim_region", "anomaly_flags", "revenue_forecasts")
SUMMARIES = ("fact_daily", "fact_category", "fact_bitmaps")


def warehouse_views(spark: SparkSession, warehouse_root: str) -> dict[str, DataFrame]:
    wh = Warehouse(spark, warehouse_root)
    t = {name: wh.read_or_empty(name) for name in [*TABLES, *SUMMARIES]}
    if wh.summarised():  # the views then read no fact line
        from_fact = {
            "vw_kpi_summary": views.kpi_summary_merged(
                t["fact_daily"], t["fact_bitmaps"], t["dim_date"], t["anomaly_flags"]),
            "vw_sales_trend": views.sales_trend_merged(
                t["fact_daily"], t["fact_bitmaps"], t["dim_date"], t["dim_region"]),
            "vw_region_category_breakdown": views.region_category_merged(
                t["fact_category"], t["fact_bitmaps"], t["dim_region"]),
        }
    else:
        from_fact = {
            "vw_kpi_summary": views.kpi_summary(t["fact_sales"], t["dim_date"], t["dim_customer"], t["anomaly_flags"]),
            "vw_sales_trend": views.sales_trend(t["fact_sales"], t["dim_date"], t["dim_region"]),
            "vw_region_category_breakdown": views.region_category_breakdown(
                t["fact_sales"], t["dim_region"], t["dim_product"]),
        }
    return {
        **from_fact,
        "vw_anomalies": views.anomalies(t["anomaly_flags"]),
        "vw_revenue_forecast": views.revenue_forecast(t["revenue_forecasts"]),
    }


def register_views(spark: SparkSession, warehouse_root: str) -> list[str]:
    """Tables and views as temp views, for SQL clients of the session."""
    wh = Warehouse(spark, warehouse_root)
    for name in TABLES:
        wh.read_or_empty(name).createOrReplaceTempView(name)
    names = []
    for name, df in warehouse_views(spark, warehouse_root).items():
        df.createOrReplaceTempView(name)
        names.append(name)
    return names


def query(spark: SparkSession, warehouse_root: str, sql: str, **params) -> DataFrame:
    """SQL over the warehouse tables and views, with named parameters
    (``:run_date`` style), as a lazy DataFrame."""
    register_views(spark, warehouse_root)
    return spark.sql(sql, args=params or None)
