"""M1 validate: type the raw columns, label each row with its first failing
rule, split accepted from rejected, and count reasons.

One labelled frame feeds three outputs (accepted, rejected, report); callers
that use more than one should persist it (``validate`` does).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions import columns as C

SOURCE_COLUMNS = [
    "InvoiceNo", "StockCode", "Description", "Quantity",
    "InvoiceDate", "UnitPrice", "CustomerID", "Country",
]
# Columns that must be present in every row, in the order their reasons are
# given (a fixed order; see README, quirk Q3), then Description.
MISSING_ORDER = ["InvoiceNo", "StockCode", "Quantity", "InvoiceDate", "UnitPrice", "Country"]
RAW_KEPT = {
    "Quantity": "raw_quantity",
    "UnitPrice": "raw_unit_price",
    "InvoiceDate": "raw_invoice_date",
    "CustomerID": "raw_customer_id",
}
REASON = "rejection_reason"
# Text of a source record that does not have the header's number of fields.
MALFORMED = "_corrupt_record"
RAW_RECORD = "raw_record"


def require_columns(df: DataFrame, required, what: str = "required") -> None:
    """Fail before planning if columns are missing (sorted names)."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing {what} columns: {', '.join(missing)}")


def _date_lit(value) -> F.Column:
    if isinstance(value, str):
        value = dt.date.fromisoformat(value)
    return F.lit(value).cast("date")


def label_rows(raw: DataFrame, ingestion_date=None) -> DataFrame:
    """Typed columns, the raw text of typed columns, and ``rejection_reason``.

    The reason is null for accepted rows. One ``coalesce`` of ``when`` rules in
    rule order gives the first failing rule (V1-V3).
    Built in narrow stages that refer to the previous stage's columns by
    name, so no parse expression is copied into the next one (a fused tree
    outgrows the 64 KB limit of a generated method). The rows leave through a
    generator of one row each: filters on the reason stay above it, where they
    would otherwise take a copy of all the parsing along to the source.
    """
    require_columns(raw, SOURCE_COLUMNS)
    extras = [c for c in raw.columns if c not in SOURCE_COLUMNS and c not in ("ingestion_date", MALFORMED)]
    if MALFORMED in raw.columns:
        raw = raw.withColumnRenamed(MALFORMED, RAW_RECORD)
        extras.append(RAW_RECORD)
    date_col = _date_lit(ingestion_date) if ingestion_date is not None else F.col("ingestion_date")

    # 1. null tokens; keep the text of the columns that get typed
    text = raw.select(
        *[C.null_tokens(F.col(c).cast("string")).alias(c) for c in SOURCE_COLUMNS],
        *extras,
        date_col.alias("ingestion_date"),
    )
    # 2. parse
    parsed = text.select(
        "*",
        C.lenient_double("Quantity").alias("_q"),
        C.lenient_double("UnitPrice").alias("_p"),
        C.lenient_double("CustomerID").alias("_c"),
        C.strip_ws("InvoiceDate").alias("_d"),
    )
    # 3. type: finite, whole where required, timestamp forms in order
    typed = parsed.select(
        "*",
        C.whole_number("_q").alias("_quantity"),
        C.finite("_p").alias("_unit_price"),
        F.coalesce(C.exact_long("CustomerID"), C.whole_number("_c")).alias("_customer_id"),
        C.parse_timestamp("_d").alias("_invoice_date"),
    )
    # 4. first failing rule
    rules = [F.when(F.col(RAW_RECORD).isNotNull(), F.lit("malformed_row"))] if RAW_RECORD in extras else []
    rules += [F.when(F.col(c).isNull(), F.lit(f"missing_{c.lower()}")) for c in MISSING_ORDER]
    rules += [
        F.when(F.col("Description").isNull(), F.lit("missing_description")),
        F.when(F.col("_quantity").isNull(), F.lit("invalid_quantity")),
        F.when(F.col("_unit_price").isNull(), F.lit("invalid_unit_price")),
        F.when(F.col("_invoice_date").isNull(), F.lit("invalid_invoice_date")),
        F.when(F.col("CustomerID").isNotNull() & F.col("_customer_id").isNull(), F.lit("invalid_customer_id")),
        # Rows the warehouse types cannot hold are rejected one by one.
        F.when(F.abs("_quantity") > C.MAX_QUANTITY, F.lit("out_of_range_quantity")),
        F.when((F.abs("_unit_price") >= C.MAX_MONEY) | (F.abs(F.col("_quantity") * F.col("_unit_price")) >= C.MAX_MONEY),
               F.lit("out_of_range_unit_price")),
    ]
    labelled = F.struct(
        "InvoiceNo",
        "StockCode",
        "Description",
        F.col("_quantity").alias("Quantity"),
        F.col("_invoice_date").alias("InvoiceDate"),
        F.col("_unit_price").alias("UnitPrice"),
        F.col("_customer_id").alias("CustomerID"),
        "Country",
        *extras,
        "ingestion_date",
        *[F.col(c).alias(name) for c, name in RAW_KEPT.items()],
        F.coalesce(*rules).alias(REASON),
    )
    return typed.select(F.inline(F.array(labelled)))


def accepted_rows(labelled: DataFrame) -> DataFrame:
    """V4: rows without a reason, typed; raw text columns dropped."""
    return labelled.where(F.col(REASON).isNull()).drop(REASON, RAW_RECORD, *RAW_KEPT.values())


def rejected_rows(labelled: DataFrame) -> DataFrame:
    """V4: rows with a reason, coerced values plus their raw text (Q6)."""
    return labelled.where(F.col(REASON).isNotNull())


def reason_counts(labelled: DataFrame) -> DataFrame:
    """A1: rows per rejection reason."""
    return (
        labelled.where(F.col(REASON).isNotNull())
        .groupBy(REASON)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def validation_report(labelled: DataFrame) -> DataFrame:
    """A1+A2 in one pass: one row with totals and a reason -> count map.

    The data is scanned once into at most a dozen (reason, count) groups;
    the second aggregate runs over those groups only.
    """
    by_reason = labelled.groupBy(REASON).agg(F.count(F.lit(1)).alias("n"))
    rejected = F.col(REASON).isNotNull()
    return by_reason.agg(
        F.sum("n").cast("bigint").alias("source_rows"),
        F.coalesce(F.sum(F.when(~rejected, F.col("n"))), F.lit(0)).cast("bigint").alias("accepted_rows"),
        F.coalesce(F.sum(F.when(rejected, F.col("n"))), F.lit(0)).cast("bigint").alias("rejected_rows"),
        F.coalesce(
            F.map_from_entries(
                F.sort_array(F.collect_list(F.when(rejected, F.struct(F.col(REASON), F.col("n")))))
            ),
            F.create_map().cast("map<string,bigint>"),
        ).alias("rejection_reasons"),
    )


@dataclass
class Validation:
    labelled: DataFrame
    accepted: DataFrame
    rejected: DataFrame
    report: DataFrame


def validate(raw: DataFrame, ingestion_date=None, persist: bool = True) -> Validation:
    """M1: ``(accepted, rejected, report)`` over one persisted labelling pass."""
    labelled = label_rows(raw, ingestion_date)
    if persist:
        labelled = labelled.persist()
    return Validation(labelled, accepted_rows(labelled), rejected_rows(labelled), validation_report(labelled))
