"""The daily run over files.

Layout under one root (a local path or any Hadoop URI shared by the
cluster):

    landing/raw/ingestion_date=D/          raw rows as text + source file name (K1)
    landing/validated/ingestion_date=D/    accepted rows, typed (K2)
    landing/rejected/ingestion_date=D/     rejected rows + reason + raw text (K3)
    landing/manifest/ingestion_date=D/     one JSON record (K4)
    curated/<table>/ingestion_date=D/      the batch's star tables (K5)
    warehouse/<table>/                     loaded tables (W1-W4)

Each landing and curated output replaces exactly its own date's folder, so a
rerun of a day is safe and an empty output still leaves a (empty) folder.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillroll.operators import anomaly, clean, forecast, metrics, star, validate
from tillroll.operators.warehouse import Warehouse
from tillroll.session import checkpoint_dir, configure, drop_folder, run_concurrently, written

LANDING_PARTS = ("raw", "validated", "rejected", "manifest")


def _date(value) -> dt.date:
    if value is None:
        return dt.datetime.now(dt.timezone.utc).date()
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def has_quoted_breaks(spark: SparkSession, source: str) -> bool:
    """Whether a record of the CSV runs over a line end: some line then has
    an odd number of quotes."""
    lines = spark.read.text(source)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not lines.where(quotes % 2 == 1).isEmpty()


def read_source(spark: SparkSession, source: str, multiline: bool | None = None) -> DataFrame:
    """A headed CSV (suffix ``.csv`` or none), every column as text.

    Nothing is inferred and nothing dropped: a record with fewer or more
    fields than the header keeps its text in ``_corrupt_record`` and becomes
    a rejected row. Records that run over line ends need ``multiline``, which
    makes each file one task; left open, one pass over the lines decides, so
    large files without such records still split.
    """
    suffix = os.path.splitext(source.rstrip("/"))[1].lower()
    if suffix not in ("", ".csv"):
        raise ValueError(f"'{suffix}' files are not read; give a CSV")
    if multiline is None:
        multiline = has_quoted_breaks(spark, source)
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    header = reader.option("inferSchema", False).csv(source).columns
    validate.require_columns(spark.createDataFrame([], ", ".join(f"`{c}` string" for c in header)),
                             validate.SOURCE_COLUMNS)
    schema = StructType([StructField(c, StringType()) for c in [*header, validate.MALFORMED]])
    return (
        reader.schema(schema)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", validate.MALFORMED)
        .csv(source)
    )


def _partition(root: str, area: str, part: str, d: dt.date) -> str:
    return f"{root.rstrip('/')}/{area}/{part}/ingestion_date={d.isoformat()}"


def ingest(spark: SparkSession, source: str, root: str, ingestion_date=None, multiline: bool | None = None) -> dict:
    """M2: read, validate, land four outputs; returns the validation report.

    The source is parsed once into the raw landing copy (K1); the labelled
    frame is built from that copy, persisted once, and feeds the accepted,
    rejected and report outputs.
    """
    configure(spark)
    d = _date(ingestion_date)
    source_rows = read_source(spark, source, multiline)
    paths = {part: _partition(root, "landing", part, d) for part in LANDING_PARTS}
    # K1 first: the CSV is parsed once, validation reads the columnar copy.
    source_rows.select("*", F.col("_metadata.file_path").alias("source_file")).write.mode("overwrite").parquet(
        paths["raw"]
    )
    raw = spark.read.parquet(paths["raw"]).drop("source_file")
    result = validate.validate(raw, d, persist=True)
    try:
        report_rows = []
        run_concurrently([
            lambda: result.accepted.drop("ingestion_date").write.mode("overwrite").parquet(paths["validated"]),
            lambda: result.rejected.drop("ingestion_date").write.mode("overwrite").parquet(paths["rejected"]),
            lambda: report_rows.append(result.report.first()),
        ])
        report = report_rows[0].asDict(recursive=True)
    finally:
        result.labelled.unpersist()
    manifest = spark.createDataFrame(
        [(
            os.path.basename(source.rstrip("/")),
            d.isoformat(),
            dt.datetime.now(dt.timezone.utc).isoformat(),
            [paths[p] for p in LANDING_PARTS],
            (report["source_rows"], report["accepted_rows"], report["rejected_rows"],
             dict(report["rejection_reasons"] or {})),
        )],
        "source_name string, ingestion_date string, created_at_utc string, objects array<string>, "
        "validation struct<source_rows: bigint, accepted_rows: bigint, rejected_rows: bigint, "
        "rejection_reasons: map<string, bigint>>",
    )
    manifest.coalesce(1).write.mode("overwrite").json(paths["manifest"])
    report["objects"] = [paths[p] for p in LANDING_PARTS]
    return report


def read_landing(spark: SparkSession, root: str, part: str, ingestion_date) -> DataFrame:
    """One landing partition (partition pruning on ingestion_date)."""
    d = _date(ingestion_date)
    base = f"{root.rstrip('/')}/landing/{part}"
    return spark.read.option("basePath", base).parquet(f"{base}/ingestion_date={d.isoformat()}")


def write_curated(star_tables: dict[str, DataFrame], root: str, ingestion_date) -> list[str]:
    """K5: one folder per table per date."""
    d = _date(ingestion_date)
    jobs, paths = [], []
    for table, df in star_tables.items():
        path = _partition(root, "curated", table, d)
        out = df.drop("ingestion_date") if "ingestion_date" in df.columns else df
        jobs.append(lambda out=out, path=path: out.write.mode("overwrite").parquet(path))
        paths.append(path)
    run_concurrently(jobs)  # five independent writes of one persisted batch
    return paths


def read_curated(spark: SparkSession, root: str, ingestion_date) -> dict[str, DataFrame]:
    """The five curated tables of a date; types come from Parquet."""
    d = _date(ingestion_date)
    tables = {}
    for table in star.STAR_TABLES:
        base = f"{root.rstrip('/')}/curated/{table}"
        df = spark.read.option("basePath", base).parquet(f"{base}/ingestion_date={d.isoformat()}")
        if table != "fact_sales":
            df = df.drop("ingestion_date")
        tables[table] = df
    return tables


def transform(spark: SparkSession, root: str, ingestion_date, validated: DataFrame | None = None) -> dict[str, DataFrame]:
    """Clean and model one landed partition, write the curated tables (M3,
    M9, K5). ``validated`` replaces the landing read (S3: a local file)."""
    configure(spark)
    d = _date(ingestion_date)
    source = validated if validated is not None else read_landing(spark, root, "validated", d)
    cleaned = clean.clean_transactions(source, d).persist(StorageLevel.MEMORY_AND_DISK)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/star-{uuid.uuid4().hex}"
    try:
        star_tables = star.build_star_schema(cleaned, store=lambda df, name: written(df, f"{folder}/{name}"))
        write_curated(star_tables, root, d)
    finally:
        cleaned.unpersist()
        drop_folder(spark, folder)
    return read_curated(spark, root, d)


def load(spark: SparkSession, root: str, ingestion_date) -> int:
    """M10 from the curated tables; returns the batch's fact row count
    (refused rows, in ``load_quarantine``, included)."""
    d = _date(ingestion_date)
    curated = read_curated(spark, root, d)
    Warehouse(spark, f"{root.rstrip('/')}/warehouse").load_star(curated, d)
    return curated["fact_sales"].count()  # Parquet footers: cheap


def transform_and_load(spark: SparkSession, root: str, ingestion_date, validated: DataFrame | None = None) -> int:
    """M11."""
    transform(spark, root, ingestion_date, validated)
    return load(spark, root, ingestion_date)


def warehouse_daily_metrics(spark: SparkSession, root: str, run_date=None) -> DataFrame:
    """M12 over the stored warehouse: from the summaries the loads left, so
    the fact history is not read; a warehouse that lacks some is read whole."""
    wh = Warehouse(spark, f"{root.rstrip('/')}/warehouse")
    dims = wh.read_or_empty("dim_date"), wh.read_or_empty("dim_region")
    if wh.summarised():
        return metrics.daily_metrics_merged(wh.read_or_empty("fact_daily"), *dims, run_date)
    return metrics.daily_metrics(wh.read_or_empty("fact_sales"), *dims, run_date)


def run_anomaly_detection(spark: SparkSession, root: str, run_date=None, daily: DataFrame | None = None,
                          whole: bool = False, window: int = 7, min_periods: int = 3,
                          z_threshold: float = 3.0) -> DataFrame:
    """Flags from the first changed day on are recomputed and their range
    replaced (W3); the rows equal those of a recomputation of all days, but
    for ``detected_at``, which tells when a row was last worked out. All days
    are recomputed with ``whole``, without stored flags, with other parameters
    than the last run's, or if that run did not finish. Days behind the last
    run's end count as changed: it may have left their baselines as they were.
    ``daily`` are the metrics of ``run_date`` where the caller has them."""
    configure(spark)
    params = {"window": window, "min_periods": min_periods, "z_threshold": float(z_threshold)}
    anomaly.check_parameters(**params)
    wh = Warehouse(spark, f"{root.rstrip('/')}/warehouse")
    # One row per day and region, read several times.
    daily = (warehouse_daily_metrics(spark, root, run_date) if daily is None else daily).persist()
    try:
        last = daily.agg(F.max(F.col("metric_date").cast("date"))).first()[0]
        stored = wh.read("anomaly_flags")
        if last is None:
            return wh.read_or_empty("anomaly_flags")
        setting = "-".join(str(v) for v in params.values())
        noted = (wh.anomaly_note() or "").split("_through_")
        if whole or stored is None or len(noted) != 2 or noted[0] != setting:
            wh.note_anomalies(None)
            wh.persist_anomalies(anomaly.detect_anomalies(daily, **params))
        else:
            behind = daily.where(F.col("metric_date").cast("date") > F.lit(_date(noted[1])))
            first = anomaly.first_changed_day(stored, daily).union(
                behind.select(F.min(F.col("metric_date").cast("date")))).agg(F.min("metric_date")).first()[0]
            wh.note_anomalies(None)
            if first is not None:
                wh.persist_anomalies(anomaly.detect_anomalies_since(daily, first, **params), since=first)
        wh.note_anomalies(f"{setting}_through_{last.isoformat()}")
    finally:
        daily.unpersist()
    return wh.read_or_empty("anomaly_flags")


def run_forecast(spark: SparkSession, root: str, run_date=None, horizons=(7, 30),
                 daily: DataFrame | None = None) -> DataFrame:
    """Forecast, then replace the run (W4). Without ``run_date`` the
    run date is the last metric date of all regions (Q18)."""
    configure(spark)
    wh = Warehouse(spark, f"{root.rstrip('/')}/warehouse")
    # One row per day and region; the run date and the forecasts read it.
    daily = (warehouse_daily_metrics(spark, root, run_date) if daily is None else daily).persist()
    try:
        forecasts = forecast.forecast_revenue(daily, horizons=horizons, run_date=run_date)
        effective = _date(run_date) if run_date is not None else daily.agg(F.max("metric_date")).first()[0]
        if effective is not None:
            wh.persist_forecasts(forecasts, effective)
    finally:
        daily.unpersist()
    return wh.read_or_empty("revenue_forecasts")


def run_daily(spark: SparkSession, source: str, root: str, ingestion_date=None,
              multiline: bool | None = None) -> dict:
    """Ingest -> transform -> load -> anomalies -> forecasts for one day,
    in the order the reference schedules them. The fact table is read once
    for both models: its daily metrics, a row per day and region, are kept."""
    d = _date(ingestion_date)
    report = ingest(spark, source, root, d, multiline)
    loaded = transform_and_load(spark, root, d)
    daily = warehouse_daily_metrics(spark, root, d).persist()
    run_anomaly_detection(spark, root, run_date=d, daily=daily)
    run_forecast(spark, root, run_date=d, daily=daily)
    daily.unpersist()
    return {"validation": report, "batch_fact_rows": loaded}
