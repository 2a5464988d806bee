"""tillroll: a Spark-native daily batch library for retail invoice lines.

Validate raw transactions with reject reasons, clean them, build a star
schema with deterministic keys, load it idempotently into Parquet tables,
then compute regional daily metrics, rolling z-score anomaly flags,
exponential-smoothing revenue forecasts and five reporting views.
Every step is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; no Python UDFs run in the data path.
"""

__version__ = "0.1.0"
