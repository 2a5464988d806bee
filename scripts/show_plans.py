"""Print the executed (adaptive, final) physical plan of registered queries.

Usage: python scripts/show_plans.py [sf_dir] query [query ...]
Each query runs once (to the noop sink) so the printout is AQE's final plan:
check PushedFilters / ReadSchema at the scans, which joins broadcast, where
the Exchanges are, and that WholeStageCodegen spans the per-row work.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillroll.plans.queries import registered  # noqa: E402
from tillroll.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = build_session(master="local[8]", shuffle_partitions=8)
    qs = registered()
    for name in args:
        df = qs[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        print(f"==================== {name}")
        df.explain("formatted")


if __name__ == "__main__":
    main()
