"""M3 clean: whole-row dedup, strip, validity filter, derived money columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tillroll.functions import columns as C
from tillroll.operators.validate import MALFORMED, SOURCE_COLUMNS, _date_lit, require_columns


def _typed(df: DataFrame) -> DataFrame:
    """Coerce a validated frame that arrives as text (a CSV read, S3 path):
    null tokens in every source column, then the parsers validation uses, so
    a fractional quantity is no quantity and its row is dropped."""
    if MALFORMED in df.columns:  # a record without the header's fields is no row
        df = df.where(F.col(MALFORMED).isNull()).drop(MALFORMED)
    types = dict(df.dtypes)
    text = [c for c in SOURCE_COLUMNS if types.get(c) == "string"]
    if not any(types.get(c) == "string" for c in ("Quantity", "UnitPrice", "InvoiceDate", "CustomerID")):
        return df
    out = df.withColumns({c: C.null_tokens(c) for c in text})
    parsers = {"Quantity": C.lenient_long, "UnitPrice": C.finite_double, "InvoiceDate": C.lenient_timestamp,
               "CustomerID": C.lenient_long}
    return out.withColumns({c: f(c) for c, f in parsers.items() if c in text})


def _dedup_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "ingestion_date"]


def _stripped(df: DataFrame) -> DataFrame:
    """X1/X4 after the whole-row dedup (Q24: dedup happens before the strip)."""
    return df.withColumns({
        "InvoiceNo": C.strip_ws(F.col("InvoiceNo").cast(StringType())),
        "StockCode": C.strip_ws(F.col("StockCode").cast(StringType())),
        "Description": C.strip_ws(F.coalesce(F.col("Description"), F.lit(C.UNKNOWN_PRODUCT))),
        "Country": C.strip_ws(F.coalesce(F.col("Country"), F.lit(C.UNKNOWN_COUNTRY))),
    })


def _valid() -> F.Column:
    """V5: five not-null tests, price >= 0, quantity != 0."""
    return (
        F.col("InvoiceNo").isNotNull()
        & F.col("StockCode").isNotNull()
        & F.col("InvoiceDate").isNotNull()
        & F.col("Quantity").isNotNull()
        & F.col("UnitPrice").isNotNull()
        & (F.col("UnitPrice") >= 0)
        & (F.col("Quantity") != 0)
    )


def clean_transactions(validated: DataFrame, ingestion_date=None) -> DataFrame:
    """M3 over one batch. ``ingestion_date`` overrides the frame's column.

    The dedup is one hash aggregate over all source columns; partial
    aggregation collapses repeated rows before the shuffle, so a row repeated
    millions of times costs one row per map task.
    """
    require_columns(validated, SOURCE_COLUMNS)
    typed = _typed(validated)
    if "ingestion_date" in typed.columns and ingestion_date is None:
        deduped = typed.dropDuplicates(_dedup_columns(typed) + ["ingestion_date"])
        date_col = F.col("ingestion_date")
    else:
        deduped = typed.drop("ingestion_date").dropDuplicates()
        date_col = _date_lit(ingestion_date)
    quantity = F.col("Quantity")
    gross = C.round2_half_even_binary(quantity * F.col("UnitPrice"))
    valid = _stripped(deduped).where(_valid())
    typed_out = valid.withColumns({
        "Quantity": quantity.cast("bigint"),
        "InvoiceDate": F.col("InvoiceDate").cast("timestamp_ntz"),
        "ingestion_date": date_col,
        "currency_code": F.lit(C.CURRENCY),
        "region_name": C.country_to_region("Country"),
        "gross_sales": gross,
    })
    g = F.col("gross_sales")
    return typed_out.withColumns({
        "return_amount": F.when(quantity < 0, F.abs(g)).otherwise(F.lit(0.0)),
        "net_sales": F.when(quantity >= 0, g).otherwise(F.lit(0.0)),
        "is_return": (quantity < 0) | F.upper(F.col("InvoiceNo")).startswith("C"),
    })


def cleaning_report(validated: DataFrame) -> DataFrame:
    """Counts of what cleaning removed, in one pass (Q26) [derived].

    Rows are counted after the dedup; each dropped row is charged to the
    first failing test: missing value, then negative price, then zero
    quantity.
    """
    typed = _typed(validated)
    cols = _dedup_columns(typed) + (["ingestion_date"] if "ingestion_date" in typed.columns else [])
    deduped = typed.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
    s = _stripped(deduped)
    missing = (
        F.col("InvoiceNo").isNull() | F.col("StockCode").isNull() | F.col("InvoiceDate").isNull()
        | F.col("Quantity").isNull() | F.col("UnitPrice").isNull()
    )
    negative = ~missing & (F.col("UnitPrice") < 0)
    zero = ~missing & ~negative & (F.col("Quantity") == 0)
    return s.agg(
        F.sum("copies").cast("bigint").alias("rows_in"),
        (F.sum("copies") - F.count(F.lit(1))).cast("bigint").alias("duplicate_rows"),
        F.count_if(missing).cast("bigint").alias("dropped_missing"),
        F.count_if(negative).cast("bigint").alias("dropped_negative_price"),
        F.count_if(zero).cast("bigint").alias("dropped_zero_quantity"),
        F.count_if(~missing & ~negative & ~zero).cast("bigint").alias("rows_out"),
    )
