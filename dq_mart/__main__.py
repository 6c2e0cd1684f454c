"""Command line for the four jobs (``spark-submit -m``-style use):

    python -m dq_mart land    --csv <folder> --lake <root> [--multiline] [--changed]
    python -m dq_mart profile --lake <root> --out <folder>
    python -m dq_mart etl     --lake <root> --mart <root> [--guess-dates]
    python -m dq_mart report  --mart <root> --out <root> [--run-date YYYY-MM-DD]

Paths may be local, HDFS or object-store URIs.  Each job prints a one-line
summary; results are written, never collected whole.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import functions as F

from .plans import jobs as J
from .session import get_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="dq_mart")
    sub = ap.add_subparsers(dest="job", required=True)
    p = sub.add_parser("land")
    p.add_argument("--csv", required=True)
    p.add_argument("--lake", required=True)
    p.add_argument("--multiline", action="store_true", help="fields may hold quoted newlines")
    p.add_argument("--changed", action="store_true", help="land only files that changed, by their manifest")
    p = sub.add_parser("profile")
    p.add_argument("--lake", required=True)
    p.add_argument("--out", required=True)
    p = sub.add_parser("etl")
    p.add_argument("--lake", required=True)
    p.add_argument("--mart", required=True)
    p.add_argument("--guess-dates", action="store_true", help="find each date column's layout from its values")
    p = sub.add_parser("report")
    p.add_argument("--mart", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--run-date", type=dt.date.fromisoformat, default=None)
    for sp in sub.choices.values():
        sp.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = get_session(f"dq_mart-{args.job}", master=args.master)
    if args.job == "land" and args.changed:
        report = J.land_changed_job(spark, args.csv, args.lake, multiline=args.multiline)
        summary = {r.status: r.n for r in report.groupBy("status").agg(F.count("*").alias("n")).collect()}
    elif args.job == "land":
        audit = J.land_job(spark, args.csv, args.lake, multiline=args.multiline)
        # the audits have one row per table: small by construction
        summary = {r.table_name: [r.status, r.files, r.size_bytes] for r in audit.collect()}
    elif args.job == "profile":
        metrics = J.profile_job(spark, J.read_landed(spark, args.lake))
        metrics.write.mode("overwrite").parquet(args.out)
        summary = {"metrics": args.out}
    elif args.job == "etl":
        audit = J.etl_job(spark, J.read_landed(spark, args.lake), args.mart, guess_dates=args.guess_dates)
        summary = {r.table_name: [r.rows_loaded, r.rows_rejected, r.ok] for r in audit.collect()}
    else:
        summary = {"report": J.report_job(spark, args.mart, args.out, args.run_date)}
    print(json.dumps({"job": args.job, **summary}, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
