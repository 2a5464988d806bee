"""Join helper: broadcast only what is small by construction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a side whose row count the calendar or the region list
    bounds, whatever the data. Any other side is joined plainly: Spark then
    chooses by measured bytes and may change its mind at run time."""
    return big.join(F.broadcast(small), on, how)
