"""Mergeable summaries of the fact, one set of rows per ingestion date.

A load replaces the summaries of its own date and nothing else; metrics and
views merge the dates' rows, so no later step reads the fact history again.

* ``fact_daily``: sums per (ingestion_date, date_key, region_key): what the
  daily metrics (A3) and the sales trend (A5) need. Sums, counts and extremes
  merge by adding or comparing.
* ``fact_category``: sums per (ingestion_date, region_key, category) (A6).
* ``fact_bitmaps``: distinct keys do not add up over dates, so each key gets a
  dense id (``dense_ids``) and a group holds bitmaps of the ids it has seen,
  32,768 ids a bucket. Merging is a bitwise or, counting a bit count: exact,
  with no row per key and no expansion of the fact per distinct count (A4, A5,
  A6, A8).

All rows of the summaries are bounded by the calendar, the regions, the
categories and the key dictionaries, not by the number of fact lines.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.session import cut_lineage

SUM = "decimal(24,2)"
# What is counted distinctly, and the fact column that tells it.
DISTINCT_KEYS = {"invoice": "invoice_no", "customer": "customer_key", "product": "product_key"}
FIRST_ID = 1


# -- dense ids -------------------------------------------------------------------

def dense_ids(existing: DataFrame | None, keys: DataFrame) -> DataFrame:
    """``member, id`` for the values of ``keys`` (column ``member``, and
    ``first_day``, by which new ids are dealt) that ``existing`` does not hold:
    the next integers without a gap.

    New keys are range-partitioned by day and value; a key's id is its place
    in its partition plus the sizes of the partitions before it, so numbering
    needs no global window. Keys that appear together get ids close together,
    so a day's bitmaps fill few buckets. The placing is cut from its lineage
    in the shared folder: a range partitioning worked out anew after a lost
    executor could number otherwise.
    """
    new = keys.where(F.col("member").isNotNull()).groupBy("member").agg(F.min("first_day").alias("first_day"))
    base = F.lit(FIRST_ID).cast("long")
    if existing is not None:
        new = new.join(existing.select("member"), "member", "left_anti")
        base = F.coalesce(existing.select(F.max("id") + 1).scalar(), base)
    placed = new.repartitionByRange("first_day", "member").sortWithinPartitions("first_day", "member")
    placed = cut_lineage(placed.select("member", F.monotonically_increasing_id().alias("place")))
    partition = F.shiftright("place", 33).alias("partition")
    sizes = placed.groupBy(partition).agg(F.count(F.lit(1)).alias("size"))
    before = F.sum("size").over(Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1))
    # One row per partition of the line above, whatever the number of keys.
    offsets = sizes.select("partition", F.coalesce(before, F.lit(0)).alias("offset"))
    within = F.col("place") - F.shiftleft(F.col("partition"), 33)
    return placed.select("*", partition).join(F.broadcast(offsets), "partition").select(
        "member", (base + F.col("offset") + within).alias("id"))


def add_ids(existing: DataFrame | None, keys: DataFrame) -> DataFrame:
    """The key dictionary after ``keys``: existing ids never change."""
    added = dense_ids(existing, keys)
    return added if existing is None else existing.unionByName(added)


def keys_of(fact: DataFrame, kind: str) -> DataFrame:
    """A fact's distinct keys of one kind with their first day."""
    return fact.groupBy(F.col(DISTINCT_KEYS[kind]).alias("member")).agg(F.min("date_key").alias("first_day"))


# -- summaries of one load ---------------------------------------------------------

def _units() -> Column:
    return F.sum(F.when(F.col("quantity") > 0, F.col("quantity").cast("bigint"))).alias("units")


def _money() -> list[Column]:
    return [F.sum("net_sales").cast(SUM).alias("revenue"), F.sum("return_amount").cast(SUM).alias("returns")]


def daily_rows(fact: DataFrame) -> DataFrame:
    """``fact_daily`` of fact rows."""
    return fact.groupBy("ingestion_date", "date_key", "region_key").agg(
        *_money(), _units(), F.count("net_sales").alias("priced_lines"),
        F.count_if("is_return").alias("return_lines"))


def categorized_products(dim_product: DataFrame) -> DataFrame:
    """The breakdown's CTE: product_key -> keyword category."""
    return dim_product.select("product_key", C.product_category("description").alias("category"))


def with_category(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    return fact.join(categorized_products(dim_product), "product_key")


def category_rows(fact: DataFrame, dim_product: DataFrame) -> DataFrame:
    """``fact_category`` of fact rows. A product's category never changes:
    the dimension keeps the first description."""
    return with_category(fact, dim_product).groupBy("ingestion_date", "region_key", "category").agg(*_money(), _units())


def bitmap_rows(fact: DataFrame, dim_product: DataFrame, ids: dict[str, DataFrame]) -> DataFrame:
    """``fact_bitmaps`` of fact rows, all kinds."""
    return reduce(DataFrame.unionByName, bitmap_parts(fact, dim_product, ids))


def invoice_ids(fact: DataFrame, dim_product: DataFrame, ids: DataFrame) -> DataFrame:
    """``ingestion_date, date_key, region_key, category, id`` of the invoices:
    the distinct rows from which both kinds of invoice bitmaps follow.
    ``category`` is null where a line's product is not in the dimension."""
    lines = fact.join(categorized_products(dim_product), "product_key", "left")
    seen = lines.select("ingestion_date", "date_key", "region_key", "category",
                        F.col(DISTINCT_KEYS["invoice"]).alias("member")).distinct()
    return seen.join(ids, "member").drop("member")


def bitmap_parts(fact: DataFrame, dim_product: DataFrame, ids: dict[str, DataFrame],
                 store: Callable[[DataFrame, str], DataFrame] | None = None) -> list[DataFrame]:
    """``fact_bitmaps`` of fact rows by kind: ``kind`` tells what is counted within
    which of the columns ``date_key, region_key, category`` (others null).

    Distinct keys of a group first: a hot key or group is one row per map
    task before anything is joined. With ``store``, which writes a table and
    reads it back, the invoices meet their ids once for both of their kinds.
    """
    unknown = C.stable_key(C.CUSTOMER_PREFIX, F.lit(C.UNKNOWN_CUSTOMER))
    sources = {
        "invoice_day": ("invoice", fact, ["date_key", "region_key"]),
        "invoice_category": ("invoice", with_category(fact, dim_product), ["region_key", "category"]),
        "customer": ("customer", fact.where(F.col("customer_key") != unknown), []),
        "product": ("product", fact, []),
    }
    types = {"date_key": "int", "region_key": "string", "category": "string"}
    invoices = None if store is None else store(invoice_ids(fact, dim_product, ids["invoice"]), "invoice_ids")
    parts = []
    for kind, (key, rows, within) in sources.items():
        groups = [F.col(c).alias(c) if c in within else F.lit(None).cast(t).alias(c) for c, t in types.items()]
        if key == "invoice" and invoices is not None:
            known = invoices.where(F.col("category").isNotNull()) if "category" in within else invoices
            numbered = known.select("ingestion_date", *groups, "id")  # a bit set twice is one
        else:
            seen = rows.select("ingestion_date", *groups, F.col(DISTINCT_KEYS[key]).alias("member")).distinct()
            numbered = seen.join(ids[key], "member")
        bits = numbered.groupBy(
            "ingestion_date", *types, F.bitmap_bucket_number("id").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))
        parts.append(bits.select("ingestion_date", F.lit(kind).alias("kind"), *types, "bucket", "bitmap"))
    return parts


def replace_date(existing: DataFrame | None, new: DataFrame, ingestion_date) -> DataFrame:
    """A summary table after a load of ``ingestion_date``: its rows replaced,
    all others as they were."""
    new = new.where(F.col("ingestion_date") == F.lit(ingestion_date))
    if existing is None:
        return new
    return existing.where(F.col("ingestion_date") != F.lit(ingestion_date)).unionByName(new)


# -- merging -------------------------------------------------------------------------

def merged_sums(rows: DataFrame, *keys: str) -> DataFrame:
    """Summary rows of all dates added up per ``keys``."""
    counts = [c for c in ("units", "priced_lines", "return_lines") if c in rows.columns]
    return rows.groupBy(*keys).agg(
        *[F.sum(c).cast(SUM).alias(c) for c in ("revenue", "returns")], *[F.sum(c).alias(c) for c in counts])


def merged_distinct(bitmaps: DataFrame, kind: str, *keys: str) -> DataFrame:
    """``keys, distinct``: how many different keys the merged groups hold."""
    own = bitmaps.where(F.col("kind") == kind)
    buckets = own.groupBy(*keys, "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("bits"))
    return buckets.groupBy(*keys).agg(F.sum("bits").alias("distinct"))
