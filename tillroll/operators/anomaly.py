"""M13 rolling z-score anomaly flags.

Input is one row per region and day (already aggregated), so the window's
partitions are as small as the calendar, whatever the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions import columns as C
from tillroll.operators.validate import require_columns

DAILY_COLUMNS = ["metric_date", "region_key", "region_name", "revenue", "returns"]


def check_parameters(window: int, min_periods: int, z_threshold: float) -> None:
    """V11 and Q15 as explicit errors."""
    if window < 2 or min_periods < 2:
        raise ValueError("a rolling baseline needs window >= 2 and min_periods >= 2")
    if min_periods > window:
        raise ValueError("min_periods must not exceed window")
    if z_threshold >= C.HIGH_SEVERITY:
        raise ValueError("z_threshold must be below the high-severity bound 4.0")


def _metric(name: str, dtype: str, w: Window, min_periods: int):
    """Baseline (prior rows' mean), z-score, and the baseline rounded to
    cents. Decimal input (the warehouse's money) is averaged exactly, so the
    cents are right even at half-cent ties; any other input goes through the
    lenient number rule (X6: not a number, NaN or null -> 0)."""
    c = F.col(name)
    if dtype.startswith("decimal"):
        value = F.coalesce(c, F.lit(0).cast(dtype))
        x = value.cast("double")
        exact_mean = F.avg(value).over(w)
    else:
        value = C.numeric_or_zero(c)
        x = value
        exact_mean = F.avg(x).over(w)
    enough = F.count(x).over(w) >= F.lit(min_periods)
    mean = F.when(enough, F.avg(x).over(w))
    # Zero spread (every prior value equal) gives no z-score (Q14); testing
    # min == max keeps that exact on every engine (no rounding residue).
    spread = F.max(x).over(w) > F.min(x).over(w)
    sd = F.when(enough & spread, F.stddev_pop(x).over(w))
    z = (x - mean) / sd
    z = F.when(~F.isnan(z) & (F.abs(z) < F.lit(float("inf"))), z)  # X27
    baseline_cents = F.when(enough, exact_mean).cast("decimal(14,2)")
    return value, mean, baseline_cents, z


def detect_anomalies(
    daily: DataFrame,
    window: int = 7,
    min_periods: int = 3,
    z_threshold: float = 3.0,
) -> DataFrame:
    """Every region-day with baselines, z-scores and flags.

    The window covers the ``window`` prior observed rows of the region, not
    calendar days (Q13). Money columns come out as DECIMAL(14,2), scores as
    DECIMAL(12,4) (the warehouse types); flags use the unrounded values.
    """
    require_columns(daily, DAILY_COLUMNS, "daily metric")
    check_parameters(window, min_periods, z_threshold)
    w = Window.partitionBy("region_key").orderBy("metric_date").rowsBetween(-window, -1)
    types = dict(daily.dtypes)
    rev, rev_mean, rev_base, rev_z = _metric("revenue", types["revenue"], w, min_periods)
    ret, ret_mean, ret_base, ret_z = _metric("returns", types["returns"], w, min_periods)

    staged = daily.select(
        F.col("metric_date").cast("date").alias("metric_date"),
        "region_key",
        "region_name",
        rev.cast("decimal(14,2)").alias("revenue"),
        ret.cast("decimal(14,2)").alias("returns"),
        rev_base.alias("revenue_baseline"),
        ret_base.alias("returns_baseline"),
        rev_z.alias("_rz"),
        ret_z.alias("_tz"),
    )
    t = F.lit(float(z_threshold))
    rev_alert = F.coalesce(F.abs("_rz") >= t, F.lit(False))
    ret_alert = F.coalesce(F.abs("_tz") >= t, F.lit(False))
    score = F.coalesce(F.greatest(F.abs("_rz"), F.abs("_tz")), F.lit(0.0))  # X25
    return staged.select(
        "metric_date", "region_key", "region_name", "revenue", "returns",
        "revenue_baseline", "returns_baseline",
        F.col("_rz").try_cast("decimal(12,4)").alias("revenue_zscore"),
        F.col("_tz").try_cast("decimal(12,4)").alias("returns_zscore"),
        (rev_alert | ret_alert).alias("is_anomaly"),
        F.when(rev_alert & ret_alert, F.lit("revenue_and_returns"))
        .when(rev_alert, F.lit("revenue"))
        .when(ret_alert, F.lit("returns"))
        .otherwise(F.lit("none"))
        .alias("anomaly_type"),
        score.try_cast("decimal(12,4)").alias("severity_score"),
        C.severity_band(score, z_threshold).alias("severity"),
    )


def first_changed_day(stored: DataFrame, daily: DataFrame) -> DataFrame:
    """One row, ``metric_date``: the earliest day inside ``daily``'s range on
    which stored flags and ``daily`` do not hold the same region-days with the
    same money; null if there is none. A day that left ``daily`` counts.

    One hash aggregate over both tables, a row per region and day each: a row
    counts up on one side and down on the other."""
    types = dict(daily.dtypes)

    def money(name: str):
        c = F.coalesce(F.col(name), F.lit(0)) if types[name].startswith("decimal") else C.numeric_or_zero(F.col(name))
        return c.cast("decimal(14,2)").alias(name)

    now = daily.select(F.col("metric_date").cast("date").alias("metric_date"), "region_key", "region_name",
                       money("revenue"), money("returns"))
    lo, hi = (F.lit(day).cast("date") for day in now.agg(F.min("metric_date"), F.max("metric_date")).first())
    then = stored.select(*DAILY_COLUMNS).where(F.col("metric_date").between(lo, hi))
    both = then.withColumn("_side", F.lit(1)).unionByName(now.withColumn("_side", F.lit(-1)))
    return both.groupBy(*DAILY_COLUMNS).agg(F.sum("_side").alias("_side")).where("_side != 0").agg(
        F.min("metric_date").alias("metric_date"))


def detect_anomalies_since(
    daily: DataFrame,
    since,
    window: int = 7,
    min_periods: int = 3,
    z_threshold: float = 3.0,
) -> DataFrame:
    """``detect_anomalies`` of the days from ``since`` on (a date or a column
    without rows of its own; null: none), from these and the ``window`` rows
    of each region before them, which is all that their baselines read."""
    require_columns(daily, DAILY_COLUMNS, "daily metric")
    since = since if isinstance(since, Column) else F.lit(since).cast("date")
    day = F.col("metric_date").cast("date")
    latest = Window.partitionBy("region_key").orderBy(F.col("metric_date").desc())
    before = daily.where(day < since).withColumn("_back", F.row_number().over(latest))
    read = before.where(F.col("_back") <= F.lit(window)).drop("_back").unionByName(daily.where(day >= since))
    return detect_anomalies(read, window, min_periods, z_threshold).where(F.col("metric_date") >= since)
