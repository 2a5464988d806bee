"""Retail source adapter over the TPC-H-like test tables.

Turns ``lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ part`` into the eight string
columns of a raw invoice-line file (the CSV contract the pipeline ingests),
with the dirt, returns and duplicate copies the pipeline must handle.
The rules are the fixture definition of the test data; each one is a
built-in expression, and the whole adapter is one map-side pass after the
joins (no shuffle of its own).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.tables import partition_for_join, read_table

# ---------------------------------------------------------------------------
# Fixed values of the test-data definition.
# ---------------------------------------------------------------------------
DESCRIPTION_WORDS = [
    "LIGHT", "LAMP", "BAG", "STORAGE BOX", "CUP", "MUG",
    "CARD", "PEN", "HEART", "CHRISTMAS", "CLOCK", "TOY",
]
NATION_COUNTRIES = [
    "United Kingdom", "France", "Canada", "Germany", "UK", "EIRE", "Spain", "USA",
    "Great Britain", "Norway", "Japan", "United Kingdom", "Belgium", "Portugal",
    " united kingdom ", "Australia", "Switzerland", "Italy", "United Kingdom",
    "Brazil", "Poland", "Netherlands", "Unspecified", "Finland", "United Kingdom",
]

RAW_COLUMNS = [
    "InvoiceNo", "StockCode", "Description", "Quantity",
    "InvoiceDate", "UnitPrice", "CustomerID", "Country",
]


def _lookup(values: list[str], index):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _padded(number, width: int):
    """``format_string("%0<width>d")``, without a formatter call for each row:
    only null and numbers below zero get one."""
    text = number.cast("string")
    zeros = F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))
    return F.when(number >= 0, zeros).otherwise(F.format_string(f"%0{width}d", number))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw invoice-line frame (all strings) derived from the test tables."""
    lineitem = partition_for_join(
        read_table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag"
        ),
        "l_orderkey",
    )
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")

    # Orders meet their customer's nation first (a smaller join), then both
    # sides of the lineitem join are hash-partitioned on the order key: at
    # scale these are the two shuffles the sort-merge join needs anyway, and
    # on small single-row-group inputs they spread the per-row work over all
    # cores. Small sides (nation always; part, customer at small scale) are
    # broadcast by Spark's size-based threshold.
    order_nation = partition_for_join(
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, F.col("c_nationkey") == nation.n_nationkey)
        .select("o_orderkey", "o_custkey", "o_orderdate", "n_nationkey"),
        "o_orderkey",
    )
    joined = (
        lineitem.join(order_nation, lineitem.l_orderkey == order_nation.o_orderkey)
        .join(part, lineitem.l_partkey == part.p_partkey)
    )

    k = F.col("l_orderkey")
    flag = F.col("l_returnflag")
    line = F.col("l_linenumber")
    k_text = k.cast("string")

    invoice_no = (
        F.when(k % 211 == 0, F.lit("NA"))
        .when((flag == "R") & (k % 2 == 0), F.concat(F.lit("C"), k_text))
        .when(flag == "R", F.concat(F.lit("c"), k_text))
        .when((flag == "A") & (k % 50 == 0), F.concat(F.lit("C"), k_text))
        .otherwise(k_text)
    )
    stock_code = F.concat(
        _padded(F.col("p_partkey"), 6),
        F.when(line == 7, F.lit(" ")).otherwise(F.lit("")),
    )
    description = F.when(F.col("l_partkey") % 97 != 0, F.concat(
        F.upper(F.col("p_name")),
        F.lit(" "),
        _lookup(DESCRIPTION_WORDS, F.col("p_partkey") % 12),
        F.when(line == 1, F.lit(" NEW")).otherwise(F.lit("")),
    ))
    quantity = (
        F.when(k % 83 == 0, F.lit("0"))
        .when(k % 101 == 0, F.lit("abc"))
        .when(k % 103 == 0, F.lit("2.5"))
        .otherwise(F.concat(
            F.when(flag == "R", F.lit("-")).otherwise(F.lit("")),
            F.col("l_quantity").cast("bigint").cast("string"),
        ))
    )
    invoice_date = F.when(k % 107 == 0, F.lit("not a date")).otherwise(F.concat(
        F.date_format(F.col("o_orderdate"), "dd/MM/yyyy"),
        F.lit(" "),
        _padded(line + 8, 2),
        F.lit(":"),
        _padded(F.col("l_partkey") % 60, 2),
    ))
    unit_price = (
        F.when(k % 89 == 0, F.lit("-1.0"))
        .when(k % 109 == 0, F.lit("inf"))
        .otherwise(F.col("p_retailprice").cast("decimal(12,2)").cast("string"))
    )
    customer_id = (
        F.when(k % 127 == 0, F.lit("guest"))
        .when(F.col("o_custkey") % 10 != 0, F.col("o_custkey").cast("string"))
    )
    # Rows of every 40th order appear twice; in every 80th order the copy
    # carries a trailing blank in Country (so it survives whole-row dedup).
    # The string columns are computed below the explode, so downstream
    # filters (which read Country, a generated column) stay above it and
    # never copy these expressions into their predicates.
    lines = joined.select(
        invoice_no.alias("InvoiceNo"),
        stock_code.alias("StockCode"),
        description.alias("Description"),
        quantity.alias("Quantity"),
        invoice_date.alias("InvoiceDate"),
        unit_price.alias("UnitPrice"),
        customer_id.alias("CustomerID"),
        _lookup(NATION_COUNTRIES, F.col("n_nationkey")).alias("_country"),
        (k % 80 == 0).alias("_blank_copy"),
        F.when(k % 40 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))).alias("_copies"),
    )
    copy_no = F.explode("_copies").alias("_copy")
    country = F.when((F.col("_copy") == 1) & F.col("_blank_copy"), F.concat(F.col("_country"), F.lit(" "))).otherwise(
        F.col("_country")
    )
    return lines.select("*", copy_no).select(*RAW_COLUMNS[:-1], country.alias("Country"))
