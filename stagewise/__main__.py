"""Command line: ``python -m stagewise <command> ...`` (or spark-submit it).

Commands
  pipeline  raw zone or parquet tables -> fact table + seven marts
  zones     zone maps of new raw files, for runs over some months
  refresh   incremental refresh of new raw files (Structured Streaming), then marts
  export    CSV of an allowed mart
  report    summary report lines
  payload   dashboard rows as JSON lines
"""

from __future__ import annotations

import argparse
import sys

from .session import build_session


def _jdbc(args) -> dict[str, str] | None:
    props = {}
    if getattr(args, "jdbc_driver", None) is None and not hasattr(args, "jdbc_url"):
        return None  # a command without a database
    if args.jdbc_driver:
        props["driver"] = args.jdbc_driver
    if args.jdbc_user:
        props["user"] = args.jdbc_user
    if args.jdbc_password:
        props["password"] = args.jdbc_password
    return props


def _add_jdbc(p: argparse.ArgumentParser) -> None:
    p.add_argument("--jdbc-url", help="write/read marts through JDBC instead of Parquet")
    p.add_argument("--jdbc-driver")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password")


def main(argv: list[str] | None = None, spark=None) -> int:
    """Run one command. A caller-owned ``spark`` session is used and kept open."""
    ap = argparse.ArgumentParser(prog="stagewise", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    ap.add_argument("--master", help="Spark master (default: from spark-submit / environment)")
    ap.add_argument("--cluster", action="store_true", help="apply session.CLUSTER_CONF (large-cluster settings)")
    sub = ap.add_subparsers(dest="command", required=True)

    p = sub.add_parser("pipeline", help="build the fact table and the marts")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", help="JSON-lines raw zone root (any Hadoop URI)")
    src.add_argument("--tables", help="folder of TPC-H-style parquet tables (test adapters)")
    p.add_argument("--out", required=True, help="output root for the fact table and Parquet marts")
    p.add_argument("--mode", choices=("replace", "append"), default="replace")
    p.add_argument("--first-month", help="YYYY-MM; with --raw: only activity from this month on")
    p.add_argument("--last-month", help="YYYY-MM; with --raw: only activity up to this month")
    p.add_argument("--joined", action="store_true", help="use the three-join plan instead of the fused aggregate")
    _add_jdbc(p)

    p = sub.add_parser("zones", help="bring the zone maps of a raw zone up to date")
    p.add_argument("--raw", required=True)

    p = sub.add_parser("refresh", help="process new raw files incrementally, then rebuild the marts")
    p.add_argument("--raw", required=True)
    p.add_argument("--state", required=True, help="folder for stream checkpoint and partials")
    p.add_argument("--out", required=True)
    p.add_argument("--max-files-per-trigger", type=int)
    p.add_argument("--compact", action="store_true", help="fold committed batches into a snapshot afterwards")
    p.add_argument("--fact", action="store_true", help="also write the fact table to --out (it is kept under --state)")
    _add_jdbc(p)

    for name in ("export", "report", "payload"):
        p = sub.add_parser(name)
        p.add_argument("--marts", help="root of Parquet marts")
        _add_jdbc(p)
        if name == "export":
            p.add_argument("--table", required=True)
            p.add_argument("--dest", required=True)
        if name == "payload":
            p.add_argument("--dest", required=True)
            p.add_argument("--raw", help="raw zone root, adds the raw-zone inventory section")

    args = ap.parse_args(argv)
    if args.command == "pipeline" and args.tables and (args.first_month or args.last_month):
        ap.error("--first-month and --last-month need --raw")
    own_session = spark is None
    if spark is None:
        from .session import CLUSTER_CONF

        spark = build_session(args.master, conf=CLUSTER_CONF if args.cluster else None)
    jdbc = _jdbc(args)

    if args.command == "pipeline":
        from .plans import pipeline

        kw = dict(mode=args.mode, fused=not args.joined, jdbc_url=args.jdbc_url, jdbc_properties=jdbc)
        if args.raw:
            months = dict(first_month=args.first_month, last_month=args.last_month)
            paths = pipeline.run_from_raw(spark, args.raw, args.out, **months, **kw)
        else:
            paths = pipeline.run_from_tables(spark, args.tables, args.out, **kw)
        for name, where in paths.items():
            print(f"{name}\t{where}")
    elif args.command == "zones":
        from .sources import zone_map

        for name, n in zone_map.update_maps(spark, args.raw).items():
            print(f"{name}\t{n} files mapped")
    elif args.command == "refresh":
        from .plans import pipeline
        from .sinks.writers import write_mart, write_mart_jdbc
        from .streaming.refresh import compact_partials
        from .streaming.touched import read_state_fact, read_state_marts, refresh_touched

        done = refresh_touched(spark, args.raw, args.state, args.max_files_per_trigger)
        if args.compact:
            compact_partials(spark, args.state)
        if args.fact:
            pipeline.write_fact_table(read_state_fact(spark, args.state), args.out)
        for name, mart in read_state_marts(spark, args.state).items():
            if args.jdbc_url:
                write_mart_jdbc(mart, args.jdbc_url, name, "replace", jdbc)
            else:
                write_mart(mart, args.out, name, "replace")
        print(f"batches {done.batches}, products touched {done.products}, rows scored {done.rows_scored}")
        print(f"refreshed {args.out}")
    else:
        from .plans import dashboard

        marts = dashboard.load_marts(spark, args.marts, args.jdbc_url, jdbc)
        if args.command == "export":
            from .sinks.writers import export_csv

            print(export_csv(marts, args.table, args.dest))
        elif args.command == "report":
            # a bounded report: header lines + top risks
            for row in dashboard.summary_report(marts).orderBy("line_no").toLocalIterator():
                print(row.line)
        elif args.command == "payload":
            dashboard.dashboard_payload(marts, args.raw).write.mode("overwrite").json(args.dest)
            print(args.dest)
    if own_session:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
