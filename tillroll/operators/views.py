"""M17-M21 reporting views as lazy DataFrames.

Star-schema queries here aggregate the fact on its own keys before meeting a
dimension wherever the dimension only renames a key (date_key -> full_date,
region_key -> region_name): the joins then see one row per group instead of
one per invoice line, and no hot key (the UNKNOWN customer, the UK region)
ever reaches a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.operators import partials
from tillroll.operators.joins import join_small


def _units() -> F.Column:
    """SUM(quantity) FILTER (WHERE quantity > 0); null when none."""
    return F.sum(F.when(F.col("quantity") > 0, F.col("quantity").cast("bigint")))


def kpi_summary(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_customer: DataFrame,
    anomaly_flags: DataFrame,
) -> DataFrame:
    """One row of headline numbers, from one pass over the fact.

    * J1 and J3 as semi-joins: only fact rows whose day and customer exist in
      the dimensions count, as with the inner joins. The day dimension is
      bounded by the calendar and broadcast; of the customers, keys alone
      take part and Spark chooses by measured bytes.
    * Day keys are in date order, so the first and last day are looked up for
      two keys. A customer key stands for one customer id, so distinct keys
      other than the sentinel's are the distinct customers.
    * J5, the left join to anomaly_flags on its primary key, adds no rows and
      no columns (Q19), so it is left out.
    * J8 is a scalar subquery.
    """
    fact = join_small(fact, dim_date.select("date_key"), "date_key", "left_semi")
    fact = fact.join(dim_customer.select("customer_key"), "customer_key", "left_semi")
    unknown = C.stable_key(C.CUSTOMER_PREFIX, F.lit(C.UNKNOWN_CUSTOMER))
    totals = fact.agg(
        F.max("date_key").alias("_last"),
        F.min("date_key").alias("_first"),
        F.count_distinct("invoice_no").alias("order_count"),
        F.count_distinct(F.when(F.col("customer_key") != unknown, F.col("customer_key"))).alias("customer_count"),
        F.count_distinct("product_key").alias("product_count"),
        _units().alias("units_sold"),
        F.round(F.sum("net_sales"), 2).alias("total_revenue"),
        F.round(F.sum("return_amount"), 2).alias("total_returns"),
        F.count_if(F.col("is_return")).alias("return_line_count"),
    )
    days = dim_date.select("date_key", "full_date")
    last = days.toDF("_last", "latest_sales_date")
    first = days.toDF("_first", "earliest_sales_date")
    totals = totals.join(last, "_last", "left").join(first, "_first", "left")
    anomaly_count = anomaly_flags.where(F.col("is_anomaly")).select(F.count(F.lit(1))).scalar()
    return totals.select(
        "latest_sales_date",
        "earliest_sales_date",
        "order_count",
        "customer_count",
        "product_count",
        "units_sold",
        "total_revenue",
        "total_returns",
        "return_line_count",
        anomaly_count.alias("anomaly_count"),
    )


def sales_trend(fact: DataFrame, dim_date: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Per day and region. Aggregated on (date_key, region_key) first
    (equal groups, see ``metrics.daily_metrics``), then named."""
    per_key = fact.groupBy("date_key", "region_key").agg(
        F.count_distinct("invoice_no").alias("order_count"),
        _units().alias("units_sold"),
        F.round(F.sum("net_sales"), 2).alias("revenue"),
        F.round(F.sum("return_amount"), 2).alias("returns"),
        C.half_up_ratio(F.sum("net_sales"), F.count("net_sales")).alias("average_line_revenue"),
    )
    named = per_key.join(dim_date.select("date_key", "full_date"), "date_key")
    named = join_small(named, dim_region.select("region_key", "region_name"), "region_key")
    return named.select(
        F.col("full_date").alias("sales_date"),
        "region_name",
        "order_count",
        "units_sold",
        "revenue",
        "returns",
        "average_line_revenue",
    )


def region_category_breakdown(
    fact: DataFrame,
    dim_region: DataFrame,
    dim_product: DataFrame,
) -> DataFrame:
    """Per region and product category.

    Each fact line meets its product's category (J4): Spark broadcasts the
    dimension if its measured bytes allow, else AQE splits a hot product. The aggregate then runs on (region_key,
    category), six categories per region, with map-side partial aggregation;
    the region names join that small result.
    """
    lines = fact.select("region_key", "product_key", "invoice_no", "quantity", "net_sales", "return_amount")
    with_cat = lines.join(partials.categorized_products(dim_product), "product_key")
    per_key = with_cat.groupBy("region_key", "category").agg(
        F.count_distinct("invoice_no").alias("order_count"),
        _units().alias("units_sold"),
        F.round(F.sum("net_sales"), 2).alias("revenue"),
        F.round(F.sum("return_amount"), 2).alias("returns"),
    )
    named = join_small(per_key, dim_region.select("region_key", "region_name"), "region_key")
    return named.select("region_name", "category", "order_count", "units_sold", "revenue", "returns")


# The same three views from the summaries each load leaves (see ``partials``).
# They rest on the load's checks: every stored fact row has its dimension rows.

def kpi_summary_merged(
    fact_daily: DataFrame,
    fact_bitmaps: DataFrame,
    dim_date: DataFrame,
    anomaly_flags: DataFrame,
) -> DataFrame:
    """M17 from summary rows: distinct counts are bit counts of merged
    bitmaps, everything else adds up."""
    totals = fact_daily.agg(
        F.max("date_key").alias("_last"), F.min("date_key").alias("_first"),
        F.sum("units").alias("units_sold"),
        F.round(F.sum("revenue"), 2).alias("total_revenue"), F.round(F.sum("returns"), 2).alias("total_returns"),
        F.coalesce(F.sum("return_lines"), F.lit(0)).alias("return_line_count"))
    days = dim_date.select("date_key", "full_date")
    totals = totals.join(days.toDF("_last", "latest_sales_date"), "_last", "left")
    totals = totals.join(days.toDF("_first", "earliest_sales_date"), "_first", "left")

    def distinct(kind: str) -> F.Column:
        return F.coalesce(partials.merged_distinct(fact_bitmaps, kind).select("distinct").scalar(), F.lit(0))

    anomaly_count = anomaly_flags.where(F.col("is_anomaly")).select(F.count(F.lit(1))).scalar()
    return totals.select(
        "latest_sales_date", "earliest_sales_date",
        distinct("invoice_day").alias("order_count"), distinct("customer").alias("customer_count"),
        distinct("product").alias("product_count"),
        "units_sold", "total_revenue", "total_returns", "return_line_count", anomaly_count.alias("anomaly_count"))


def _with_orders(sums: DataFrame, bitmaps: DataFrame, kind: str, *keys: str) -> DataFrame:
    """Merged sums and the distinct invoices of the same groups."""
    orders = partials.merged_distinct(bitmaps, kind, *keys).withColumnRenamed("distinct", "order_count")
    return partials.merged_sums(sums, *keys).join(orders, list(keys))


def sales_trend_merged(
    fact_daily: DataFrame,
    fact_bitmaps: DataFrame,
    dim_date: DataFrame,
    dim_region: DataFrame,
) -> DataFrame:
    """M18 from summary rows."""
    per_key = _with_orders(fact_daily, fact_bitmaps, "invoice_day", "date_key", "region_key")
    joined = per_key.join(dim_date.select("date_key", "full_date"), "date_key")
    joined = join_small(joined, dim_region.select("region_key", "region_name"), "region_key")
    return joined.select(
        F.col("full_date").alias("sales_date"), "region_name", "order_count", F.col("units").alias("units_sold"),
        F.round("revenue", 2).alias("revenue"), F.round("returns", 2).alias("returns"),
        C.half_up_ratio(F.col("revenue"), F.col("priced_lines")).alias("average_line_revenue"))


def region_category_merged(
    fact_category: DataFrame,
    fact_bitmaps: DataFrame,
    dim_region: DataFrame,
) -> DataFrame:
    """M19 from summary rows."""
    per_key = _with_orders(fact_category, fact_bitmaps, "invoice_category", "region_key", "category")
    joined = join_small(per_key, dim_region.select("region_key", "region_name"), "region_key")
    return joined.select(
        "region_name", "category", "order_count", F.col("units").alias("units_sold"),
        F.round("revenue", 2).alias("revenue"), F.round("returns", 2).alias("returns"))


def anomalies(anomaly_flags: DataFrame) -> DataFrame:
    """Flagged region-days (V8), rounded."""
    cols = [
        F.col("metric_date"),
        F.col("region_name"),
        F.round("revenue", 2).alias("revenue"),
        F.round("returns", 2).alias("returns"),
        F.round("revenue_baseline", 2).alias("revenue_baseline"),
        F.round("returns_baseline", 2).alias("returns_baseline"),
        F.round("revenue_zscore", 4).alias("revenue_zscore"),
        F.round("returns_zscore", 4).alias("returns_zscore"),
        F.col("anomaly_type"),
        F.col("severity"),
        F.round("severity_score", 4).alias("severity_score"),
    ]
    if "detected_at" in anomaly_flags.columns:
        cols.append(F.col("detected_at"))
    return anomaly_flags.where(F.col("is_anomaly")).select(*cols)


def revenue_forecast(revenue_forecasts: DataFrame) -> DataFrame:
    """M21."""
    cols = [
        "forecast_run_date",
        "forecast_date",
        "region_name",
        "horizon_days",
        F.round("forecast_revenue", 2).alias("forecast_revenue"),
        "model_name",
    ]
    if "created_at" in revenue_forecasts.columns:
        cols.append("created_at")
    return revenue_forecasts.select(*cols)
