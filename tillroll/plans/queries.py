"""Registered queries: one per operator group of the inventory, each a
``(spark, sf_dir) -> DataFrame`` over the whole test tables.

Outputs are made engine-neutral at the end (see ``comparable``) so they
compare value for value with the SQL twins in ``tillroll.plans.oracle``;
inside, every step keeps the warehouse types. The queries of one session
compose over one shared ``Scenario`` (``scenario(spark, sf)``), which stores
the tables the daily run would write.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

from tillroll import schemas
from tillroll.operators import anomaly, checks, clean, forecast, metrics, validate, views, warehouse
from tillroll.plans.scenario import BATCH_DATE, RUN_DATE, SECOND_DATE, Scenario, scenario


# Integer columns that may hold nulls; compared as DOUBLE so every client
# reads them the same way (some turn nullable integers into floats).
NULLABLE_INTEGERS = ["CustomerID", "Quantity", "units_sold"]


def comparable(df: DataFrame) -> DataFrame:
    """Engine-neutral output: DECIMAL -> DOUBLE, small integers -> BIGINT,
    nullable integers -> DOUBLE, DATE -> 'yyyy-MM-dd' and TIMESTAMP ->
    'yyyy-MM-dd HH:mm:ss' text (identical through collect, Arrow or pandas)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (IntegerType, ShortType, ByteType, LongType)):
            c = c.cast("double") if f.name in NULLABLE_INTEGERS else c.cast("bigint")
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# -- validation ---------------------------------------------------------------

def validate_reason_counts(spark, sf):
    return validate.reason_counts(scenario(spark, sf).batch.labelled)


def validate_accepted(spark, sf):
    return scenario(spark, sf).batch.accepted


def validate_rejected(spark, sf):
    return scenario(spark, sf).batch.rejected


def validate_totals(spark, sf):
    report = validate.validation_report(scenario(spark, sf).batch.labelled)
    return report.select(
        "source_rows", "accepted_rows", "rejected_rows",
        F.size("rejection_reasons").cast("bigint").alias("reason_kinds"),
    )


def validate_reason_map(spark, sf):
    """The report's map, entry by entry."""
    report = validate.validation_report(scenario(spark, sf).batch.labelled)
    return report.select(F.explode("rejection_reasons").alias("rejection_reason", "row_count"))


# -- cleaning -------------------------------------------------------------------

def clean_transactions(spark, sf):
    return scenario(spark, sf).batch.cleaned


def clean_drop_counts(spark, sf):
    return clean.cleaning_report(scenario(spark, sf).batch.accepted)


def country_region(spark, sf):
    cleaned = scenario(spark, sf).batch.cleaned
    return cleaned.groupBy("Country", "region_name").agg(F.count(F.lit(1)).alias("row_count"))


# -- star schema ----------------------------------------------------------------

def dim_product(spark, sf):
    return scenario(spark, sf).batch.star["dim_product"]


def dim_customer(spark, sf):
    return scenario(spark, sf).batch.star["dim_customer"]


def dim_region(spark, sf):
    return scenario(spark, sf).batch.star["dim_region"]


def dim_date(spark, sf):
    return scenario(spark, sf).batch.star["dim_date"]


def fact_sales(spark, sf):
    return scenario(spark, sf).batch.star["fact_sales"]


# -- loads ----------------------------------------------------------------------

def load_dim_insert_if_absent(spark, sf):
    dims = scenario(spark, sf).dims_ab
    product = dims["dim_product"].select(
        F.lit("dim_product").alias("dimension"), F.col("product_key").alias("member_key"),
        F.col("stock_code").alias("natural_key"), F.col("description").alias("attribute"),
    )
    customer = dims["dim_customer"].select(
        F.lit("dim_customer").alias("dimension"), F.col("customer_key").alias("member_key"),
        F.col("customer_id").alias("natural_key"), F.col("country").alias("attribute"),
    )
    return product.unionByName(customer)


def load_fact_first_write_wins(spark, sf):
    return scenario(spark, sf).fact_ab


def load_fact_rerun(spark, sf):
    return scenario(spark, sf).fact_rerun


def anomaly_range_replace(spark, sf):
    s = scenario(spark, sf)
    before = anomaly.detect_anomalies(s.daily_of(s.fact_ab, s.dims_ab))
    rerun = anomaly.detect_anomalies(s.daily_of(s.fact_rerun, s.dims_rerun, RUN_DATE))
    return warehouse.replace_anomaly_range(before, rerun)


def forecast_run_replace(spark, sf):
    s = scenario(spark, sf)
    daily_ab = s.daily_of(s.fact_ab, s.dims_ab)
    daily_rerun = s.daily_of(s.fact_rerun, s.dims_rerun)
    first = forecast.forecast_revenue(daily_ab)
    # A backfill run with an explicit run date ...
    backfill = forecast.forecast_revenue(s.daily_of(s.fact_rerun, s.dims_rerun, RUN_DATE), run_date=RUN_DATE)
    state = warehouse.replace_forecast_run(first, backfill, RUN_DATE)
    # ... then a run without one: rows carry each region's last day, the
    # delete uses the global last day (Q18).
    latest = daily_rerun.select(F.max("metric_date")).scalar()
    return warehouse.replace_forecast_run(state, forecast.forecast_revenue(daily_rerun), latest)


# -- metrics and models -----------------------------------------------------------

def daily_metrics(spark, sf):
    return scenario(spark, sf).daily()


def daily_metrics_bounded(spark, sf):
    return scenario(spark, sf).daily(RUN_DATE)


def anomaly_baselines(spark, sf):
    return scenario(spark, sf).flags.select(
        "metric_date", "region_key", "revenue", "returns", "revenue_baseline",
        "returns_baseline", "revenue_zscore", "returns_zscore",
    )


def anomaly_flags(spark, sf):
    return scenario(spark, sf).flags


def anomaly_by_severity(spark, sf):
    return scenario(spark, sf).flags.groupBy("region_name", "severity", "anomaly_type").agg(
        F.count(F.lit(1)).alias("region_days")
    )


def forecast_levels(spark, sf):
    levels = forecast.smoothing_levels(scenario(spark, sf).daily())
    return levels.select(
        "region_key", "region_name", "first_date", "last_date",
        F.col("n_days").cast("bigint").alias("n_days"),
        F.round("alpha", 6).alias("alpha"),
        F.round("level", 2).alias("level"),
    )


def forecast_rows(spark, sf):
    return scenario(spark, sf).forecasts


def forecast_repeated_horizon(spark, sf):
    """A horizon given twice is stored once."""
    rows = forecast.forecast_revenue(scenario(spark, sf).daily(), horizons=(7, 7), run_date=BATCH_DATE)
    return warehouse.replace_forecast_run(None, rows, BATCH_DATE)


# -- views ------------------------------------------------------------------------

def vw_kpi_summary(spark, sf):
    s = scenario(spark, sf)
    d = s.dims()
    return views.kpi_summary(s.fact, d["dim_date"], d["dim_customer"], s.flags)


def vw_sales_trend(spark, sf):
    s = scenario(spark, sf)
    d = s.dims()
    return views.sales_trend(s.fact, d["dim_date"], d["dim_region"])


def vw_region_category_breakdown(spark, sf):
    s = scenario(spark, sf)
    d = s.dims()
    return views.region_category_breakdown(s.fact, d["dim_region"], d["dim_product"])


def vw_anomalies(spark, sf):
    return views.anomalies(scenario(spark, sf).flags)


def vw_revenue_forecast(spark, sf):
    return views.revenue_forecast(scenario(spark, sf).forecasts)


# -- from the summaries of a load sequence (two dates, then the first rerun) --------

def daily_metrics_merged(spark, sf):
    s = scenario(spark, sf)
    d = s.dims_rerun
    return metrics.daily_metrics_merged(s.summaries["fact_daily"], d["dim_date"], d["dim_region"])


def daily_metrics_merged_bounded(spark, sf):
    s = scenario(spark, sf)
    d = s.dims_rerun
    return metrics.daily_metrics_merged(s.summaries["fact_daily"], d["dim_date"], d["dim_region"], RUN_DATE)


def vw_kpi_summary_merged(spark, sf):
    s = scenario(spark, sf)
    flags = anomaly.detect_anomalies(daily_metrics_merged(spark, sf))
    return views.kpi_summary_merged(
        s.summaries["fact_daily"], s.summaries["fact_bitmaps"], s.dims_rerun["dim_date"], flags)


def vw_sales_trend_merged(spark, sf):
    s = scenario(spark, sf)
    d = s.dims_rerun
    return views.sales_trend_merged(
        s.summaries["fact_daily"], s.summaries["fact_bitmaps"], d["dim_date"], d["dim_region"])


def vw_region_category_merged(spark, sf):
    s = scenario(spark, sf)
    return views.region_category_merged(
        s.summaries["fact_category"], s.summaries["fact_bitmaps"], s.dims_rerun["dim_region"])


def key_ids_dense(spark, sf):
    """The dictionaries behind the bitmaps: ids without a gap or a repeat."""
    parts = [ids.agg(
        F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("members"), F.count_distinct("member").alias("distinct_members"),
        F.count_distinct("id").alias("distinct_ids"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))
        for kind, ids in scenario(spark, sf).key_ids.items()]
    return reduce(DataFrame.unionByName, parts)


def load_quarantine(spark, sf):
    """The second batch's facts against the first batch's dimensions alone:
    references are absent, so a load refuses these rows and says why."""
    s = scenario(spark, sf)
    rows = s.batch_b.star["fact_sales"].withColumn(checks.VIOLATIONS, checks.row_violations("fact_sales"))
    rows = checks.with_orphans(rows, "fact_sales", {t: s.batch_a.star[t] for t in warehouse.DIMENSION_KEYS})
    refused = checks.quarantined(rows, "fact_sales", SECOND_DATE)
    return refused.select(
        "ingestion_date", "table_name", F.array_join("violations", ",").alias("violations"),
        F.get_json_object("record", "$.transaction_id").alias("transaction_id"),
        F.get_json_object("record", "$.product_key").alias("product_key"))


# -- checks -------------------------------------------------------------------------

def _loaded_tables(s: Scenario, with_batch_fact: bool = False) -> dict[str, DataFrame]:
    tables = {name: schemas.conform(df, name) for name, df in s.dims().items()}
    fact = s.batch.fact_rows if with_batch_fact else s.fact
    tables["fact_sales"] = schemas.conform(fact, "fact_sales")
    tables["anomaly_flags"] = s.flags
    tables["revenue_forecasts"] = s.forecasts
    return tables


def check_unique(spark, sf):
    """Before the load's dedup, so the transaction_id collisions (Q24) show."""
    return checks.unique_report(_loaded_tables(scenario(spark, sf), with_batch_fact=True))


def check_unique_loaded(spark, sf):
    """After the load sequence: sales are told by id and day, as loads do."""
    s = scenario(spark, sf)
    return checks.unique_report({**s.dims_rerun, "fact_sales": s.fact_rerun}, checks.LOADED_KEYS)


def check_foreign_keys(spark, sf):
    return checks.foreign_key_report(_loaded_tables(scenario(spark, sf)))


def check_foreign_keys_first_dims(spark, sf):
    """The facts of both batches against the dimensions of the first one:
    references are absent here, so the check must say so."""
    s = scenario(spark, sf)
    tables = {t: schemas.conform(s.batch_a.star[t], t) for t in warehouse.DIMENSION_KEYS}
    return checks.foreign_key_report({**tables, "fact_sales": schemas.conform(s.fact_ab, "fact_sales")})


def check_not_null(spark, sf):
    tables = _loaded_tables(scenario(spark, sf))
    tables["anomaly_flags"] = tables["anomaly_flags"].withColumn("detected_at", F.lit(BATCH_DATE).cast("timestamp"))
    tables["revenue_forecasts"] = tables["revenue_forecasts"].withColumn(
        "created_at", F.lit(BATCH_DATE).cast("timestamp"))
    return checks.not_null_report(tables)


def anomaly_restart(spark, sf):
    """Flags after the rerun shrank a day: those stored, replaced from the
    first changed day on."""
    s = scenario(spark, sf)
    before = anomaly.detect_anomalies(s.daily_of(s.fact_ab, s.dims_ab))
    daily = s.daily_of(s.fact_rerun, s.dims_rerun)
    first = anomaly.first_changed_day(before, daily).first()[0]
    last = daily.agg(F.max("metric_date")).first()[0]
    return warehouse.replace_anomaly_range(before, anomaly.detect_anomalies_since(daily, first), (first, last))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        validate_reason_counts, validate_accepted, validate_rejected, validate_totals, validate_reason_map,
        clean_transactions, clean_drop_counts, country_region,
        dim_product, dim_customer, dim_region, dim_date, fact_sales,
        load_dim_insert_if_absent, load_fact_first_write_wins, load_fact_rerun,
        anomaly_range_replace, anomaly_restart, forecast_run_replace,
        daily_metrics, daily_metrics_bounded,
        anomaly_baselines, anomaly_flags, anomaly_by_severity,
        forecast_levels, forecast_rows, forecast_repeated_horizon,
        vw_kpi_summary, vw_sales_trend, vw_region_category_breakdown, vw_anomalies, vw_revenue_forecast,
        daily_metrics_merged, daily_metrics_merged_bounded, vw_kpi_summary_merged, vw_sales_trend_merged,
        vw_region_category_merged, key_ids_dense, load_quarantine, check_unique_loaded,
        check_unique, check_foreign_keys, check_foreign_keys_first_dims, check_not_null,
    ]
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda f: lambda spark, sf: comparable(f(spark, sf)))(f) for name, f in QUERIES.items()}
