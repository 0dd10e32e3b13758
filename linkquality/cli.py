"""Command line: the scheduled entry points of the pipeline.

    python -m linkquality backfill 2023-01 2023-03 --landing L --bronze B
    python -m linkquality monthly [YEAR MONTH] --landing L --bronze B   # default: previous month
    python -m linkquality daily --landing L --bronze B                  # current month
    python -m linkquality refresh --bronze B --warehouse W [--months 2023-10 ...]

Each command is one Spark job over all the months it covers (a backfill is
not a loop of per-month jobs).  Run it with ``spark-submit`` on a cluster;
``spark.checkpoint.dir`` must then name a shared folder, and ``--input-bytes`` with ``--cores``
sizes input splits and shuffle partitions for the run.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json

from .conf import build_session, scale_conf
from .functions.time import default_month
from .plans.jobs import ingest_months, refresh_warehouse


def _month(y: int, m: int) -> str:
    return f"{y:04d}-{m:02d}"


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="linkquality")
    sub = p.add_subparsers(dest="cmd", required=True)

    def ingest_args(q):
        q.add_argument("--landing", required=True)
        q.add_argument("--bronze", required=True)
        q.add_argument("--tz", default="Europe/Athens")
        q.add_argument("--ambiguous", default="infer", choices=["infer", "runs", "earlier", "later"])
        q.add_argument("--allow-missing-fields", action="store_true")

    b = sub.add_parser("backfill", help="ingest every month from START to END (YYYY-MM)")
    b.add_argument("start")
    b.add_argument("end")
    ingest_args(b)
    m = sub.add_parser("monthly", help="ingest one month, by default the previous one")
    m.add_argument("year", type=int, nargs="?")
    m.add_argument("month", type=int, nargs="?")
    ingest_args(m)
    d = sub.add_parser("daily", help="re-ingest the current month")
    ingest_args(d)
    r = sub.add_parser("refresh", help="rebuild silver, sessions and gold from bronze")
    r.add_argument("--bronze", required=True)
    r.add_argument("--warehouse", required=True)
    r.add_argument("--months", nargs="*")
    r.add_argument("--silver-by", default="month", choices=["month", "day"])
    r.add_argument("--sessions-by", default="none", choices=["none", "day"])
    for q in (b, m, d, r):
        q.add_argument("--input-bytes", type=int, help="size of the input, to size splits and shuffles")
        q.add_argument("--cores", type=int, help="cores of the cluster")
    return p.parse_args(argv)


def months_for(args: argparse.Namespace, today: _dt.date) -> tuple[str, str]:
    """(start, end) months a command covers."""
    if args.cmd == "backfill":
        return args.start, args.end
    if args.cmd == "monthly":
        if args.year is None or args.month is None:
            y, mo = default_month(today, "monthly")
        else:
            y, mo = args.year, args.month
        return _month(y, mo), _month(y, mo)
    y, mo = default_month(today, "daily")
    return _month(y, mo), _month(y, mo)


def main(argv: list[str] | None = None, today: _dt.date | None = None) -> dict:
    args = parse(argv)
    if bool(args.input_bytes) != bool(args.cores):
        raise SystemExit("--input-bytes and --cores go together")
    spark = build_session(extra=scale_conf(args.input_bytes, args.cores) if args.cores else None)
    if args.cmd == "refresh":
        paths = refresh_warehouse(spark, args.bronze, args.warehouse,
                                  months=args.months or None,
                                  silver_by=args.silver_by, sessions_by=args.sessions_by)
        out = {"cmd": "refresh", "tables": paths}
    else:
        start, end = months_for(args, today or _dt.date.today())
        ingest_months(spark, args.landing, args.bronze, start=start, end=end, tz=args.tz,
                      ambiguous=args.ambiguous, require_fields=not args.allow_missing_fields)
        out = {"cmd": args.cmd, "start": start, "end": end}
    print(json.dumps(out))
    return out
