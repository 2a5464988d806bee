"""Command line: ``python -m tillroll <step> ...``.

    ingest     --source PATH --root ROOT [--ingestion-date D] [--multiline]
    transform  --root ROOT --ingestion-date D [--input VALIDATED_CSV]   (clean, model, load)
    anomalies  --root ROOT [--run-date D]
    forecast   --root ROOT [--run-date D]
    daily      --source PATH --root ROOT [--ingestion-date D]
    views      --root ROOT [--show N]
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from tillroll.plans import daily_run, reporting
from tillroll.session import build_session


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m tillroll", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--master", help="Spark master (default: from spark-submit / local)")
    sub = p.add_subparsers(dest="step", required=True)
    ingest = sub.add_parser("ingest")
    ingest.add_argument("--source", required=True)
    ingest.add_argument("--root", required=True)
    ingest.add_argument("--ingestion-date", type=dt.date.fromisoformat)
    ingest.add_argument("--multiline", action="store_true", default=None)
    transform = sub.add_parser("transform")
    transform.add_argument("--root", required=True)
    transform.add_argument("--ingestion-date", required=True, type=dt.date.fromisoformat)
    transform.add_argument("--input", help="a local validated CSV instead of the landing partition")
    for name in ("anomalies", "forecast"):
        s = sub.add_parser(name)
        s.add_argument("--root", required=True)
        s.add_argument("--run-date", type=dt.date.fromisoformat)
    daily = sub.add_parser("daily")
    daily.add_argument("--source", required=True)
    daily.add_argument("--root", required=True)
    daily.add_argument("--ingestion-date", type=dt.date.fromisoformat)
    daily.add_argument("--multiline", action="store_true", default=None)
    views = sub.add_parser("views")
    views.add_argument("--root", required=True)
    views.add_argument("--show", type=int, default=20)
    return p


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session(master=args.master)
    if args.step == "ingest":
        out = daily_run.ingest(spark, args.source, args.root, args.ingestion_date, args.multiline)
    elif args.step == "transform":
        validated = daily_run.read_source(spark, args.input) if args.input else None
        out = {"batch_fact_rows": daily_run.transform_and_load(spark, args.root, args.ingestion_date, validated)}
    elif args.step == "anomalies":
        out = {"rows": daily_run.run_anomaly_detection(spark, args.root, run_date=args.run_date).count()}
    elif args.step == "forecast":
        out = {"rows": daily_run.run_forecast(spark, args.root, run_date=args.run_date).count()}
    elif args.step == "daily":
        out = daily_run.run_daily(spark, args.source, args.root, args.ingestion_date, args.multiline)
    else:
        for name, df in reporting.warehouse_views(spark, f"{args.root.rstrip('/')}/warehouse").items():
            print(f"== {name}")
            df.show(args.show, truncate=False)
        return 0
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
