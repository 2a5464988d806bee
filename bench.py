"""Benchmark: headline queries over the whole tables at $BENCH_SF_DIR.

Each query runs to completion through Spark's ``noop`` sink (every row is
produced, nothing is collected to the driver). ``daily_run`` times the whole
file-based daily run (ingest -> landing -> clean -> curated star -> load ->
anomalies -> forecasts) over the adapter's rows written once, untimed, as a
CSV source into a fresh temporary folder. Prints one JSON line: ``queries``
are times with one scenario shared by the session, in order, as in earlier
rounds; ``cold`` are times of each query alone, nothing cached.
Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_QUERIES (optional comma-separated subset).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll.plans import daily_run  # noqa: E402
from tillroll.plans.queries import registered  # noqa: E402
from tillroll.plans.scenario import reset  # noqa: E402
from tillroll.sources.retail_adapter import raw_transactions  # noqa: E402
from tillroll.session import build_session  # noqa: E402

HEADLINE = [
    "validate_reason_counts",
    "clean_transactions",
    "fact_sales",
    "load_fact_rerun",
    "daily_metrics",
    "anomaly_flags",
    "forecast_rows",
    "vw_kpi_summary",
    "vw_sales_trend",
    "vw_region_category_breakdown",
]


def time_daily_run(spark, sf_dir: str) -> float:
    run_dir = tempfile.mkdtemp(prefix="tillroll-bench-")
    source = os.path.join(run_dir, "source")
    (
        raw_transactions(spark, sf_dir).write.option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(source)
    )
    spark.catalog.clearCache()
    t0 = time.perf_counter()
    daily_run.run_daily(spark, source, os.path.join(run_dir, "lake"), "2026-07-21")
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = build_session(
        app_name="tillroll-bench",
        master=f"local[{cpus}]",
        shuffle_partitions=max(cpus, 8),
    )
    qs = registered()
    # Warm the JVM once on the smallest tables so the first timed query
    # does not pay class loading alone.
    warm_dir = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm_dir):
        qs["vw_sales_trend"](spark, warm_dir).write.format("noop").mode("overwrite").save()
    timings, cold = {}, {}
    for name in names:
        reset(spark)
        t0 = time.perf_counter()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            cold[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:
            print(f"{name} failed: {exc}", file=sys.stderr)
            cold[name] = None
    reset(spark)
    for name in names:
        t0 = time.perf_counter()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # keep the record of the other queries
            print(f"{name} failed: {exc}", file=sys.stderr)
            timings[name] = None
    if not os.environ.get("BENCH_QUERIES"):
        try:
            timings["daily_run"] = time_daily_run(spark, sf_dir)
        except Exception as exc:  # report the queries even if the file run fails
            print(f"daily_run failed: {exc}", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(v for v in timings.values() if v is not None), 3),
        "unit": "sec",
        "queries": timings,
        "cold": cold,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
