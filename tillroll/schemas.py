"""The warehouse tables' types, and a cast to them before each write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _s(*fields) -> StructType:
    return StructType([StructField(n, t, nullable) for n, t, nullable in fields])


MONEY = DecimalType(14, 2)
PRICE = DecimalType(12, 2)
SCORE = DecimalType(12, 4)

DIM_PRODUCT = _s(("product_key", StringType(), False), ("stock_code", StringType(), False),
                 ("description", StringType(), False))
DIM_CUSTOMER = _s(("customer_key", StringType(), False), ("customer_id", StringType(), False),
                  ("country", StringType(), False))
DIM_DATE = _s(("date_key", IntegerType(), False), ("full_date", DateType(), False),
              ("year", IntegerType(), False), ("quarter", IntegerType(), False),
              ("month", IntegerType(), False), ("month_name", StringType(), False),
              ("week_of_year", IntegerType(), False), ("day_of_month", IntegerType(), False))
DIM_REGION = _s(("region_key", StringType(), False), ("region_name", StringType(), False))
FACT_SALES = _s(("transaction_id", StringType(), False), ("invoice_no", StringType(), False),
                ("product_key", StringType(), False), ("customer_key", StringType(), False),
                ("date_key", IntegerType(), False), ("region_key", StringType(), False),
                ("quantity", IntegerType(), False), ("unit_price", PRICE, False),
                ("currency_code", StringType(), False), ("gross_sales", MONEY, False),
                ("return_amount", MONEY, False), ("net_sales", MONEY, False),
                ("is_return", BooleanType(), False), ("ingestion_date", DateType(), False))
ANOMALY_FLAGS = _s(("metric_date", DateType(), False), ("region_key", StringType(), False),
                   ("region_name", StringType(), False), ("revenue", MONEY, False),
                   ("returns", MONEY, False), ("revenue_baseline", MONEY, True),
                   ("returns_baseline", MONEY, True), ("revenue_zscore", SCORE, True),
                   ("returns_zscore", SCORE, True), ("is_anomaly", BooleanType(), False),
                   ("anomaly_type", StringType(), False), ("severity_score", SCORE, False),
                   ("severity", StringType(), False), ("detected_at", TimestampType(), False))
REVENUE_FORECASTS = _s(("forecast_run_date", DateType(), False), ("forecast_date", DateType(), False),
                       ("region_key", StringType(), False), ("region_name", StringType(), False),
                       ("horizon_days", IntegerType(), False), ("forecast_revenue", MONEY, False),
                       ("model_name", StringType(), False), ("created_at", TimestampType(), False))

# Summaries and key dictionaries a load leaves (see ``operators.partials``).
SUM = DecimalType(24, 2)
FACT_DAILY = _s(("ingestion_date", DateType(), False), ("date_key", IntegerType(), False),
                ("region_key", StringType(), False), ("revenue", SUM, False), ("returns", SUM, False),
                ("units", LongType(), True), ("priced_lines", LongType(), False), ("return_lines", LongType(), False))
FACT_CATEGORY = _s(("ingestion_date", DateType(), False), ("region_key", StringType(), False),
                   ("category", StringType(), False), ("revenue", SUM, False), ("returns", SUM, False),
                   ("units", LongType(), True))
FACT_BITMAPS = _s(("ingestion_date", DateType(), False), ("kind", StringType(), False),
                  ("date_key", IntegerType(), True), ("region_key", StringType(), True),
                  ("category", StringType(), True), ("bucket", LongType(), False), ("bitmap", BinaryType(), False))
KEY_IDS = _s(("member", StringType(), False), ("id", LongType(), False))
# Rows a load refused: which table, every rule they break, and the row as JSON.
QUARANTINE = _s(("ingestion_date", DateType(), False), ("table_name", StringType(), False),
                ("violations", ArrayType(StringType()), False), ("record", StringType(), False))

TABLES = {
    "dim_product": DIM_PRODUCT,
    "dim_customer": DIM_CUSTOMER,
    "dim_date": DIM_DATE,
    "dim_region": DIM_REGION,
    "fact_sales": FACT_SALES,
    "anomaly_flags": ANOMALY_FLAGS,
    "revenue_forecasts": REVENUE_FORECASTS,
    "fact_daily": FACT_DAILY,
    "fact_category": FACT_CATEGORY,
    "fact_bitmaps": FACT_BITMAPS,
    "ids_invoice": KEY_IDS,
    "ids_customer": KEY_IDS,
    "ids_product": KEY_IDS,
    "load_quarantine": QUARANTINE,
}

# Text length limits of the warehouse contract (checked by C3).
LENGTH_LIMITS = {
    "dim_product": {"product_key": 64, "stock_code": 64},
    "dim_customer": {"customer_key": 64, "customer_id": 64, "country": 128},
    "dim_date": {"month_name": 20},
    "dim_region": {"region_key": 64, "region_name": 64},
    "fact_sales": {"transaction_id": 64, "invoice_no": 64, "product_key": 64, "customer_key": 64,
                   "region_key": 64, "currency_code": 3},
    "anomaly_flags": {"region_key": 64, "region_name": 64, "anomaly_type": 32, "severity": 16},
    "revenue_forecasts": {"region_key": 64, "region_name": 64, "model_name": 64},
}


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the table's columns in order, cast to its types. Decimal casts
    round half up and fail on overflow, as the database's NUMERIC would."""
    schema = TABLES[table]
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
