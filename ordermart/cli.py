"""Command line for the three jobs (usable with spark-submit):

    spark-submit ordermart/cli.py clean     --feeds <dir> --out <dir> [--log <dir>]
    spark-submit ordermart/cli.py analytics --processed <dir> --out <dir> [--serving <dir>] [--log <dir>]
    spark-submit ordermart/cli.py forecast  --seller-monthly <dir> --out <dir> [--log <dir>]
    spark-submit ordermart/cli.py benchmark --processed <dir> --out <dir> [--jsonl <dir>] [--runs N]

``--window-start/--window-end`` and ``--split-year`` override the reference defaults.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ordermart.config import REFERENCE  # noqa: E402
from ordermart.plans import jobs  # noqa: E402
from ordermart.session import build_session  # noqa: E402


def _params(args):
    p = REFERENCE
    clean = p.clean
    if args.window_start:
        clean = replace(clean, start_date=args.window_start)
    if args.window_end:
        clean = replace(clean, end_date=args.window_end)
    forecast = replace(p.forecast, split_year=args.split_year) if args.split_year else p.forecast
    return replace(p, clean=clean, forecast=forecast)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="ordermart")
    ap.add_argument("step", choices=["clean", "analytics", "forecast", "benchmark"])
    ap.add_argument("--jsonl")
    ap.add_argument("--runs", type=int, default=3)
    ap.add_argument("--feeds")
    ap.add_argument("--processed")
    ap.add_argument("--seller-monthly")
    ap.add_argument("--out", required=True)
    ap.add_argument("--log")
    ap.add_argument("--serving")
    ap.add_argument("--window-start")
    ap.add_argument("--window-end")
    ap.add_argument("--split-year", type=int)
    args = ap.parse_args(argv)
    spark = build_session(app_name=f"ordermart-{args.step}")
    params = _params(args)
    if args.step == "clean":
        out = jobs.run_clean(spark, args.feeds, args.out, params, log_path=args.log)
    elif args.step == "analytics":
        out = jobs.run_analytics(spark, args.processed, args.out, params, log_path=args.log,
                                 serving_root=args.serving)
    elif args.step == "forecast":
        out = jobs.run_forecast(spark, args.seller_monthly, args.out, params, log_path=args.log)
    else:
        out = jobs.run_benchmark(spark, args.processed, args.out, max(3, args.runs), args.jsonl)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
