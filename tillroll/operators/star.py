"""M4-M9 star schema: four dimensions and the sales fact, keyed by hashes of
natural keys, so the fact is a narrow map of the cleaned rows (no lookup
join) and reruns produce the same keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import columns as C

STAR_TABLES = ("fact_sales", "dim_product", "dim_customer", "dim_date", "dim_region")

# The fact table's columns, in the table's order.
FACT_COLUMNS = [
    "transaction_id", "invoice_no", "product_key", "customer_key", "date_key", "region_key",
    "quantity", "unit_price", "currency_code", "gross_sales", "return_amount", "net_sales",
    "is_return", "ingestion_date",
]


def order_micros(at: str) -> F.Column:
    """A timestamp as a long to order by; null comes first, as in a struct."""
    return F.coalesce(F.unix_micros(F.col(at).cast("timestamp")), F.lit(-(2**63)))


# Writes a frame under a name and reads it back.
Store = Callable[[DataFrame, str], DataFrame]


def _keep_first(df: DataFrame, key: str, attr: str, out_key: str, out_attr: str,
                store: Store | None = None) -> DataFrame:
    """A11 with an explicit total order (Q9): earliest InvoiceDate, then
    InvoiceNo, then the attribute itself.

    The earliest moment per key and attribute is a minimum of longs, which a
    hash aggregate holds in place: one row per pair and task is shuffled, also
    of a key with a third of all rows, and no row is sorted. A key with one
    attribute at its earliest moment is done. Only where several meet there,
    the rows of that moment are read for their InvoiceNo; with ``store`` these
    keys are written first, so a short list is broadcast and no row moves.
    """
    rows = df.select(F.col(key).alias(out_key), F.col(attr).alias(out_attr), "InvoiceNo",
                     order_micros("InvoiceDate").alias("_at"))
    pairs = rows.groupBy(out_key, out_attr).agg(F.min("_at").alias("_at"))
    # The smallest and the largest attribute of a key's earliest moment.
    first = pairs.groupBy(out_key).agg(
        F.min(F.struct("_at", out_attr)).alias("_low"),
        F.max(F.struct(F.bitwise_not("_at").alias("_till"), out_attr)).alias("_high"),
    ).select(out_key, F.col("_low._at").alias("_at"), F.col(f"_low.{out_attr}").alias(out_attr),
             F.col(f"_high.{out_attr}").alias("_last"))
    one = F.col(out_attr).eqNullSafe(F.col("_last"))
    if store is not None:
        first = store(first, f"first_{out_attr}")
    contested = first.where(~one).select(out_key, "_at")
    if store is not None:
        contested = store(contested, f"contested_{out_attr}")
    tied = rows.alias("r").join(
        contested.alias("f"),
        F.col(f"r.{out_key}").eqNullSafe(F.col(f"f.{out_key}")) & (F.col("r._at") == F.col("f._at")), "left_semi")
    settled = tied.groupBy(out_key).agg(F.min_by(out_attr, F.struct("InvoiceNo", out_attr)).alias(out_attr))
    return first.where(one).select(out_key, out_attr).unionByName(settled)


def customer_id_text() -> F.Column:
    """Customer id as text, ``UNKNOWN`` when absent."""
    return F.coalesce(F.col("CustomerID").cast("string"), F.lit(C.UNKNOWN_CUSTOMER))


def dim_product(cleaned: DataFrame, store: Store | None = None) -> DataFrame:
    """M4."""
    products = _keep_first(cleaned, "StockCode", "Description", "stock_code", "description", store)
    return products.select(
        C.stable_key(C.PRODUCT_PREFIX, "stock_code").alias("product_key"), "stock_code", "description"
    )


def dim_customer(cleaned: DataFrame, store: Store | None = None) -> DataFrame:
    """M5, with the UNKNOWN member for rows without a customer."""
    customers = _keep_first(
        cleaned.withColumn("customer_id", customer_id_text()), "customer_id", "Country", "customer_id", "country", store
    )
    return customers.select(
        C.stable_key(C.CUSTOMER_PREFIX, "customer_id").alias("customer_key"), "customer_id", "country"
    )


def dim_region(cleaned: DataFrame) -> DataFrame:
    """M6: at most three rows (the region function has three values)."""
    regions = cleaned.select("region_name").distinct()
    return regions.select(C.stable_key(C.REGION_PREFIX, "region_name").alias("region_key"), "region_name")


def dim_date(cleaned: DataFrame) -> DataFrame:
    """M7: observed days only."""
    days = cleaned.select(F.to_date("InvoiceDate").alias("full_date")).distinct()
    d = F.col("full_date")
    return days.select(
        C.date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
    )


def transaction_text() -> F.Column:
    """X16 (Q8 fixed): invoice|stock|yyyy-MM-dd HH:mm:ss|quantity|price."""
    return F.concat_ws(
        "|",
        F.col("InvoiceNo"),
        F.col("StockCode"),
        F.date_format(F.col("InvoiceDate"), "yyyy-MM-dd HH:mm:ss"),
        F.col("Quantity").cast("bigint").cast("string"),
        F.col("UnitPrice").cast("double").cast("string"),
    )


def region_key(name: str) -> F.Column:
    """``stable_key`` of a region; those of the known regions are constants of
    the plan, not hashed row by row."""
    keys = F.when(F.col(name) == C.REGIONS[0], C.stable_key(C.REGION_PREFIX, F.lit(C.REGIONS[0])))
    for region in C.REGIONS[1:]:
        keys = keys.when(F.col(name) == region, C.stable_key(C.REGION_PREFIX, F.lit(region)))
    return keys.otherwise(C.stable_key(C.REGION_PREFIX, name))


def fact_sales(cleaned: DataFrame) -> DataFrame:
    """M8: one row per cleaned invoice line, typed for the warehouse (Q27:
    prices are rounded to cents after the hash was taken)."""
    return cleaned.select(
        C.stable_key(C.TRANSACTION_PREFIX, transaction_text()).alias("transaction_id"),
        F.col("InvoiceNo").alias("invoice_no"),
        C.stable_key(C.PRODUCT_PREFIX, "StockCode").alias("product_key"),
        C.stable_key(C.CUSTOMER_PREFIX, customer_id_text()).alias("customer_key"),
        C.date_key("InvoiceDate").alias("date_key"),
        region_key("region_name").alias("region_key"),
        F.col("Quantity").cast("int").alias("quantity"),
        F.col("UnitPrice").cast("decimal(12,2)").alias("unit_price"),
        F.col("currency_code"),
        F.col("gross_sales").cast("decimal(14,2)").alias("gross_sales"),
        F.col("return_amount").cast("decimal(14,2)").alias("return_amount"),
        F.col("net_sales").cast("decimal(14,2)").alias("net_sales"),
        F.col("is_return"),
        F.col("ingestion_date").cast("date").alias("ingestion_date"),
    )


def star_table(name: str, cleaned: DataFrame, store: Store | None = None) -> DataFrame:
    """One table of the star. ``store`` writes what the keep-first dimensions
    look up on the way."""
    if name in ("dim_product", "dim_customer"):
        return {"dim_product": dim_product, "dim_customer": dim_customer}[name](cleaned, store)
    return {"dim_date": dim_date, "dim_region": dim_region, "fact_sales": fact_sales}[name](cleaned)


def build_star_schema(cleaned: DataFrame, check_empty: bool = True, store: Store | None = None) -> dict[str, DataFrame]:
    """M9. ``check_empty`` runs V6 (one small job): an empty batch is an error."""
    if check_empty and cleaned.isEmpty():
        raise ValueError("the batch is empty: cleaning kept no row")
    return {name: star_table(name, cleaned, store)
            for name in ("dim_product", "dim_customer", "dim_date", "dim_region", "fact_sales")}
