"""Command line: python -m driftglass {silver,gold,merge,daily,late,stale,counts,reprocess} --lake FOLDER [--date D ...]."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime

from driftglass.functions.text import content_version, strict_date
from driftglass.plans import adhoc, lake, medallion, planner
from driftglass.session import build_session


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="driftglass", description=__doc__)
    parser.add_argument("command", choices=["silver", "gold", "merge", "daily", "late", "stale", "counts", "reprocess"])
    parser.add_argument("--lake", required=True)
    parser.add_argument("--date", nargs="*", default=[], type=lambda d: strict_date(d).isoformat())
    parser.add_argument("--stage", default="silver", choices=["silver", "gold"])
    parser.add_argument("--no-cascade", action="store_true")
    parser.add_argument("--apply", action="store_true")
    args = parser.parse_args(argv)
    spark, at = build_session(), args.lake.rstrip("/")
    with open(medallion.__file__, "rb") as f:
        version = content_version(f.read())
    steps = {
        "silver": lambda d: medallion.silver_date(spark, f"{at}/bronze", f"{at}/silver", f"{at}/markers/silver", d, version),
        "gold": lambda d: medallion.gold_date(spark, f"{at}/silver", f"{at}/gold", f"{at}/markers/gold", d, version),
        "merge": lambda d: {"date": d, "status": lake.compact(spark, f"{at}/bronze", d, ["icao24", "timestamp"])},
    }
    code, out = 0, []
    if args.command in steps:
        out, code = medallion.run_dates(steps[args.command], args.date)
    elif args.command == "daily":
        today = datetime.now(UTC).strftime("%Y-%m-%d")
        out = [medallion.run_daily(spark, f"{at}/bronze", f"{at}/silver", f"{at}/gold", f"{at}/markers", today, version)]
    elif args.command == "late":
        out = [r.asDict() for r in lake.late_files(spark, f"{at}/bronze", f"{at}/markers/silver").collect()]
    elif args.command == "stale":
        out = [r.asDict() for r in lake.stale(lake.markers_table(spark, f"{at}/markers/{args.stage}"), version).collect()]
    elif args.command == "counts":
        for name in lake.register_views(spark, f"{at}/gold"):
            out.append({"table": name, **adhoc.date_list(spark.table(name)).first().asDict()})
    else:
        requests = spark.createDataFrame([(k, args.stage, d) for k, d in enumerate(args.date)], "pos long, stage string, dt string")
        todo = [r.asDict() for r in planner.reprocess(requests, not args.no_cascade).orderBy("pos").collect()]
        out = todo
        if args.apply:
            results = [medallion.run_dates(steps[t["stage"]], [t["dt"]]) for t in todo]
            out, code = [r for rows, _ in results for r in rows], max((c for _, c in results), default=0)
    for row in out:
        print(json.dumps(row, default=str))
    return code


if __name__ == "__main__":
    sys.exit(main())
