"""M12 regional daily metrics (A3 over J1 + J2, optional bound V7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.operators.joins import join_small
from tillroll.operators.partials import merged_sums


def daily_metrics(
    fact: DataFrame,
    dim_date: DataFrame,
    dim_region: DataFrame,
    run_date=None,
) -> DataFrame:
    """Revenue (sum of net_sales) and returns per day and region.

    The fact is aggregated on its own keys first (partial + final hash
    aggregate: one row per day and region leaves each map task), and only
    that small result meets the two dimensions. Grouping by (date_key,
    region_key) equals grouping by (full_date, region_key, region_name)
    because both dimensions are unique on their keys and date_key is a
    function of full_date (C1 checks both).
    The bound is applied to the fact's date_key too, so it prunes the scan
    (Parquet row-group statistics) instead of only the date dimension.
    """
    fact, dim_date = bounded(fact, dim_date, run_date)
    per_key = fact.groupBy("date_key", "region_key").agg(
        F.sum("net_sales").alias("revenue"),
        F.sum("return_amount").alias("returns"),
    )
    return named(per_key, dim_date, dim_region)


def daily_metrics_merged(
    fact_daily: DataFrame,
    dim_date: DataFrame,
    dim_region: DataFrame,
    run_date=None,
) -> DataFrame:
    """The same metrics from the summaries that each load leaves
    (``partials.daily_rows``): a row per ingestion date, day and region is
    read instead of the fact history."""
    fact_daily, dim_date = bounded(fact_daily, dim_date, run_date)
    per_key = merged_sums(fact_daily.select("date_key", "region_key", "revenue", "returns"), "date_key", "region_key")
    return named(per_key, dim_date, dim_region)


def bounded(rows: DataFrame, dim_date: DataFrame, run_date) -> tuple[DataFrame, DataFrame]:
    """V7 on the rows' day key and on the day dimension."""
    if run_date is None:
        return rows, dim_date
    if isinstance(run_date, str):
        run_date = dt.date.fromisoformat(run_date)
    bound_key = run_date.year * 10000 + run_date.month * 100 + run_date.day
    return rows.where(F.col("date_key") <= F.lit(bound_key)), dim_date.where(F.col("full_date") <= F.lit(run_date))


def named(per_key: DataFrame, dim_date: DataFrame, dim_region: DataFrame) -> DataFrame:
    """Sums per key with the day and the region's name."""
    # dim_region has at most one row per region (three by construction).
    joined = per_key.join(dim_date.select("date_key", "full_date"), "date_key")
    joined = join_small(joined, dim_region.select("region_key", "region_name"), "region_key")
    return joined.select(
        F.col("full_date").alias("metric_date"),
        "region_key",
        "region_name",
        "revenue",
        "returns",
    )
