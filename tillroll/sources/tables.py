"""Parquet table access for the given test tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def partition_for_join(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition ``df`` on its join keys, as a rebalance.

    At scale this is the shuffle a sort-merge join on ``keys`` needs; on a
    small input read from one row group it spreads all per-row work after
    the scan over the cores instead of one task. A rebalance (unlike a
    plain repartition) lets AQE split a partition that one hot key makes
    too large and merge small ones.
    """
    return df.hint("rebalance", *keys)
