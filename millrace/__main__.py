"""Run a layer: python -m millrace --layer all --root <lake> --landing <folder>."""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from millrace.plans.layers import run_layers, day_report
from millrace.session import build_session
from millrace.sources.tables import Lake


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Run one layer, or all in order.")
    parser.add_argument("--layer", required=True, choices=["raw", "validate", "staging", "curated", "all"])
    parser.add_argument("--feeds", default="all", help="feed names with commas between, or all; no effect on curated")
    parser.add_argument("--root", required=True, help="folder of the layer tables")
    parser.add_argument("--landing", help="folder with one folder of files per feed")
    parser.add_argument("--at", help="batch time as YYYY-MM-DDTHH:MM:SS; now when left out")
    parser.add_argument("--threads", type=int, default=4, help="feeds worked on at the same time")
    parser.add_argument("--full-scan", action="store_true", help="validate all of RAW again, not what is new alone")
    args = parser.parse_args(argv)

    at = dt.datetime.fromisoformat(args.at) if args.at else dt.datetime.now().replace(microsecond=0)
    lake = Lake(build_session(), args.root)
    outcomes = run_layers(lake, args.layer, at, args.landing, args.feeds, args.threads, args.full_scan)
    outcomes.show(outcomes.count(), truncate=80)
    for report in day_report(lake, at.date()):
        report.show(report.count(), truncate=60)
    return 1 if outcomes.where("status = 'FAILED'").count() else 0


if __name__ == "__main__":
    sys.exit(main())
