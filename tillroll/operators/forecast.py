"""M15 simple-exponential-smoothing revenue forecasts.

The level recursion l0 = x0, li = a*xi + (1-a)*l(i-1) over a zero-filled
daily series has the closed form

    level = sum_i x_i * (1-a)^(n-1-i) * (a if i > 0 else 1)

with i the day offset from the region's first day and n the number of
calendar days first..last. Days without data add nothing, so no calendar
spine is built and the level is one grouped aggregate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.operators.validate import require_columns

MODEL_NAME = "simple_exponential_smoothing"


def check_horizons(horizons) -> tuple[int, ...]:
    horizons = tuple(int(h) for h in horizons)
    if not horizons or any(h <= 0 for h in horizons):
        raise ValueError("every horizon must be a number of days above zero")
    return horizons


def smoothing_levels(daily: DataFrame) -> DataFrame:
    """Per region: first and last day, n, alpha and the final level."""
    require_columns(daily, ["metric_date", "region_key", "region_name", "revenue"], "forecast")
    region = ["region_key", "region_name"]
    per_day = daily.groupBy(*region, F.col("metric_date").cast("date").alias("day")).agg(
        F.sum(C.numeric_or_zero("revenue")).alias("x")  # F1 + X6
    )
    w = Window.partitionBy(*region)
    staged = per_day.select(
        *region, "day", "x",
        F.min("day").over(w).alias("first_date"),
        F.max("day").over(w).alias("last_date"),
    )
    n = F.datediff("last_date", "first_date") + 1
    alpha = F.least(F.lit(1.0), F.greatest(F.lit(0.01), F.lit(2.0) / (n + 1)))  # F2 + X28
    offset = F.datediff("day", "first_date")
    weight = F.pow(F.lit(1.0) - F.col("alpha"), F.col("n_days") - 1 - offset) * F.when(
        offset == 0, F.lit(1.0)
    ).otherwise(F.col("alpha"))
    return (
        staged.withColumn("n_days", n)
        .withColumn("alpha", alpha)
        .groupBy(*region, "first_date", "last_date", "n_days", "alpha")
        .agg(F.sum(F.col("x") * weight).alias("level"))  # F3
    )


def forecast_revenue(daily: DataFrame, horizons=(7, 30), run_date=None) -> DataFrame:
    """Flat forecasts for each horizon, starting the day after each region's
    own last day (Q17); ``forecast_run_date`` is ``run_date`` or that last
    day (X33, Q18). Rows: sum of horizons per region."""
    horizons = check_horizons(horizons)
    if isinstance(run_date, str):
        run_date = dt.date.fromisoformat(run_date)
    levels = smoothing_levels(daily)
    value = F.round(F.greatest(F.col("level"), F.lit(0.0)), 2)  # F4
    run = F.lit(run_date).cast("date") if run_date is not None else F.col("last_date")
    return (
        levels.select(
            "region_key", "region_name", "last_date", value.alias("forecast_revenue"),
            F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon_days"),
        )
        .select(
            "*", F.explode(F.sequence(F.lit(1), F.col("horizon_days"))).alias("_step")  # F5
        )
        .select(
            run.alias("forecast_run_date"),
            F.date_add("last_date", F.col("_step")).alias("forecast_date"),
            "region_key",
            "region_name",
            F.col("horizon_days").cast("int").alias("horizon_days"),
            F.col("forecast_revenue").cast("decimal(14,2)").alias("forecast_revenue"),
            F.lit(MODEL_NAME).alias("model_name"),
        )
    )
