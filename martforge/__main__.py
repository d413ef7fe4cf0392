"""Command line: ``python -m martforge <command> --sf-dir DIR [...]``.

build   build the star and the marts from the driver tables, or with --csv-dir
        from <table>.csv of the six extracts, run the 50 model tests, and publish everything atomically under --out (a failing
        error-severity test aborts before anything is published)
check   print the data-quality report (the 50 model tests, or --constraints)
query   show the first rows of a registered query
list    list the registered queries
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="martforge")
    ap.add_argument("command", choices=["build", "check", "query", "list"])
    ap.add_argument("name", nargs="?", help="query name (for 'query')")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--csv-dir", help="folder of the six CSV extracts (instead of --sf-dir)")
    ap.add_argument("--out", help="publish root (for 'build')")
    ap.add_argument("--master", default=None)
    ap.add_argument("--constraints", action="store_true", help="check the DDL constraints")
    ap.add_argument("--rows", type=int, default=20)
    ap.add_argument("--threads", type=int, default=4, help="concurrent models per wave")
    args = ap.parse_args(argv)

    from martforge.plans import registry

    if args.command == "list":
        print("\n".join(sorted(registry.queries())))
        return 0

    from martforge.session import build_session
    spark = build_session(args.master)
    from martforge.plans import checks as C
    from martforge.plans.warehouse import warehouse_for

    if args.csv_dir:
        from martforge.plans.warehouse import Warehouse
        from martforge.session import scratch_path
        from martforge.sources.landing import csv_paths, csv_to_landing
        landing = f"{args.out}/landing" if args.out else scratch_path(spark, "landing")
        wh = Warehouse(spark, csv_to_landing(spark, csv_paths(args.csv_dir), landing))
    else:
        wh = warehouse_for(spark, args.sf_dir)
    if args.command == "check":
        suite = C.CONSTRAINT_SUITE if args.constraints else C.DBT_SUITE
        C.run_checks(wh, suite).orderBy("check_name").show(len(suite), truncate=False)
        return 0
    if args.command == "query":
        if args.name not in registry.queries():
            print(f"unknown query {args.name!r}; see 'list'", file=sys.stderr)
            return 2
        registry.queries()[args.name](spark, args.sf_dir).show(args.rows, truncate=False)
        return 0
    # build
    if not args.out:
        print("build needs --out", file=sys.stderr)
        return 2
    from martforge.plans.publish import new_version, publish_version
    from martforge.plans.warehouse import PublishedWarehouse, write_warehouse
    # write the star into its version folder (concurrent models per wave, each in
    # its layout), then the marts; test what is written; then switch the pointer
    version = new_version()
    root = f"{args.out}/{version}"
    write_warehouse(wh, root, threads=args.threads)
    pw = PublishedWarehouse(spark, root)
    for name, fn in C.MART_MODELS.items():
        pw.store_mart(name, fn(pw))
    staging_checks = [c for c in C.DBT_SUITE if c.model.startswith("stg_")]
    report = C.run_checks(wh, staging_checks).unionByName(C.run_checks(pw, C.MART_SUITE))
    for w in publish_version(spark, args.out, version, report):
        print(f"warning: {w['check_name']} failed on {w['failing_rows']} rows", file=sys.stderr)
    print(f"published {version} under {args.out}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
