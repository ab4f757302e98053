"""Command line: ``python -m rollcall <command>``.

  plan    list landed files and label them LOAD / SKIP / IGNORED
  ingest  append snapshots whose date is not in the raw store yet
  build   raw store -> staged -> clean -> marts, with the data checks
  export  publish the current picture
  close   all of the above in one run (stops on an error-level check)

Seeds are CSV files with a header: region lookup (region_code, region_name,
latitude, longitude), region corrections (snapshot_date, entity_type,
region_code, entity_no, region_code_fixed) and name corrections
(snapshot_date, entity_type, region_code, entity_no, entity_name_fixed). Their keys
must be unique; a name correction's date may be empty.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import functions as F


def _seeds(spark, args):
    from rollcall.plans import staging as S
    from rollcall.sources import raw_store as R
    entity = ["entity_type", "region_code", "entity_no"]
    read = lambda path, schema, keys, nullable=(): R.read_seed(
        spark, path, schema, keys, set(nullable), args.quarantine) if path else None
    lookup = read(args.regions, S.REGION_LOOKUP_SCHEMA, ["region_code"])
    rfix = read(args.region_fixes, S.REGION_CORRECTION_SCHEMA, ["snapshot_date", *entity])
    nfix = read(args.name_fixes, S.NAME_CORRECTION_SCHEMA, ["snapshot_date", *entity], ["snapshot_date"])
    geo = lookup.where(F.col("latitude").isNotNull()) if lookup is not None else None
    return lookup, rfix, nfix, geo


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="rollcall")
    p.add_argument("command", choices=["plan", "ingest", "build", "export", "close"])
    p.add_argument("--landing")
    p.add_argument("--store", help="raw store path")
    p.add_argument("--marts", help="output folder of the marts")
    p.add_argument("--publish", help="output folder of the publication")
    p.add_argument("--ext", default=".csv")
    p.add_argument("--regions")
    p.add_argument("--region-fixes")
    p.add_argument("--name-fixes")
    p.add_argument("--quarantine", help="table for seed rows that can't be used; without it they stop the run")
    p.add_argument("--warn-only", action="store_true", help="report error-level checks, do not stop")
    args = p.parse_args(argv)

    from rollcall.session import get_session
    from rollcall.plans import ingest as I
    from rollcall.plans import close as CL
    from rollcall.sources import raw_store as R
    from rollcall.sources import export as EX
    from rollcall.plans.staging import PUBLICATION_ORDER
    spark = get_session()
    out: dict = {"command": args.command}
    if args.command == "plan":
        files = R.list_snapshots(spark, args.landing).select("file_name", "snapshot").distinct()
        plan = I.plan_ingest(files, R.loaded_dates(spark, args.store), ext=args.ext)
        out["files"] = {r["status"]: r["files"] for r in I.run_counters(plan).collect()}
    elif args.command == "ingest":
        done = I.load_landing(spark, args.landing, args.store, ext=args.ext)
        out["files"], out["rows_loaded"] = done.plan, done.rows
    elif args.command in ("build", "close"):
        lookup, rfix, nfix, geo = _seeds(spark, args)
        res = CL.monthly_close(spark, args.landing, args.store, args.marts, lookup, rfix, nfix, geo,
                               ext=args.ext, publish_dir=args.publish if args.command == "close" else None,
                               stop_on_error=not args.warn_only) if args.command == "close" else \
            CL.build_marts(spark, args.store, args.marts, lookup, rfix, nfix, geo,
                           stop_on_error=not args.warn_only)
        out.update(plan=res.plan, rows_loaded=res.rows_loaded, marts=res.marts,
                   publication=res.publication,
                   checks=[{"check": c["check"], "failures": c["failures"], "status": c["status"]}
                           for c in res.checks])
    elif args.command == "export":
        out["publication"] = EX.export_current(spark.read.parquet(f"{args.marts.rstrip('/')}/current"),
                                               args.publish, order=PUBLICATION_ORDER)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
