"""Command line.

    python -m lateflow stream --events /root/testdata/sf0.001 --out OUT [--slice-minutes 15]
        land the trip events in arrival slices, run the streaming job (availableNow),
        compact the tables, print the reconciliation
    python -m lateflow demo --out OUT [--day YYYY-MM-DD] [--no-restore]
        new columns, a day rebuilt wrongly, what it lost, and the restore, on OUT's tables
    python -m lateflow replay --events DIR [--window-minutes 15 ...]
        the same policy as one batch query; prints the reconciliation
    python -m lateflow query NAME --events DIR [--show 20]
        run a registered query

On a cluster pass ``--master`` only if the launcher does not set it; the checkpoint
folder comes from ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from lateflow.schemas import COUNTS_TABLE, DEFAULT_SLICE_MINUTES, LatenessPolicy


def _policy(args) -> LatenessPolicy:
    return LatenessPolicy(args.window_minutes, args.allowed_lateness_minutes,
                          not args.count_missing_zone)


def cmd_stream(spark, args) -> int:
    from lateflow.sources.arrivals import trip_events
    from lateflow.streaming.job import land_slices, report, run_stream

    out = args.out.rstrip("/")
    landed = land_slices(trip_events(spark, args.events), out + "/landing", args.slice_minutes)
    print(f"landed {landed['events']:,} events in {landed['files']} slice files")
    tables, store = run_stream(spark, out + "/landing", out, _policy(args))
    if not args.skip_compact:
        for name, t in tables.items():
            m = t.compact()
            print(f"compact {name}: {m['numFilesRemoved']} files -> {m['numFilesAdded']}")
    summary = report(tables, store, landed)
    print(json.dumps(summary, indent=2))
    for name, t in tables.items():
        print(name, t.describe())
    return 0 if summary["balanced"] else 1


def _show(df) -> None:
    df.show(df.count(), False)


def cmd_demo(spark, args) -> int:
    from pyspark.sql import functions as F

    from lateflow.operators.repair import recount, row_difference, zone_change
    from lateflow.operators.versions import busiest_day
    from lateflow.schemas import BAD_CORRECTION_JOB, JOB_TAG, LATE_TABLE
    from lateflow.sources.ledger import pipeline_tables

    tables = pipeline_tables(spark, args.out.rstrip("/") + "/tables")
    if not all(t.exists() for t in tables.values()):
        print("no tables under", args.out, "- run the stream first", file=sys.stderr)
        return 2
    for name, table in tables.items():
        for change in table.schema_changes():
            print(f"{name} v{change['version']}: new columns {change['columns']}")
            part = table.spec.partition_column
            _show(table.read().groupBy(part).agg(F.count(F.lit(1)).alias("rows"), *[
                F.count(c).alias(f"with_{c}") for c in change["columns"]]).orderBy(part))
    late, counts = tables[LATE_TABLE].read(), tables[COUNTS_TABLE]
    busiest = busiest_day(late).first()
    if busiest is None and not args.day:
        print("no late trips", file=sys.stderr)
        return 2
    day = dt.date.fromisoformat(args.day) if args.day else busiest["day"]
    good = counts.version()
    bad = counts.overwrite_partitions(recount(late, day, F.current_timestamp()),
                                      [day.isoformat()], tags={JOB_TAG: BAD_CORRECTION_JOB})
    print(f"{day} rebuilt from late trips alone: v{bad}")

    def of_day(version=None):
        return counts.read(version).filter(F.col("window_date") == F.lit(day))

    _show(zone_change(of_day(good), of_day(bad)).orderBy("zone"))
    if args.no_restore:
        return 0
    counts.restore(good)
    rest = row_difference(counts.read(), counts.read(good)).first()
    print(f"v{good} restored as v{counts.version()}; rows that differ: {tuple(rest)}")
    return 0 if tuple(rest) == (0, 0) else 1


def cmd_replay(spark, args) -> int:
    from lateflow.plans.replay import Replay
    from lateflow.sources.arrivals import trip_events

    r = Replay(trip_events(spark, args.events), _policy(args), args.slice_minutes)
    row = r.reconcile().first().asDict()
    print(json.dumps(row, indent=2))
    return 0 if row["reconciles"] else 1


def cmd_query(spark, args) -> int:
    from lateflow.queries import SPARK

    if args.name not in SPARK:
        print("unknown query; one of:", ", ".join(sorted(SPARK)), file=sys.stderr)
        return 2
    found = SPARK[args.name](spark, args.events).cache()
    total = found.count()
    found.show(args.show, False)
    if total > args.show:
        print(f"{args.show} of {total:,} rows")
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lateflow", description=__doc__.splitlines()[0])
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    def policy_args(sp):
        sp.add_argument("--window-minutes", type=int, default=15)
        sp.add_argument("--allowed-lateness-minutes", type=int, default=10)
        sp.add_argument("--slice-minutes", type=int, default=DEFAULT_SLICE_MINUTES)
        sp.add_argument("--count-missing-zone", action="store_true")

    s = sub.add_parser("stream")
    s.add_argument("--events", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--skip-compact", action="store_true")
    policy_args(s)
    d = sub.add_parser("demo")
    d.add_argument("--out", required=True)
    d.add_argument("--day", default=None)
    d.add_argument("--no-restore", action="store_true")
    r = sub.add_parser("replay")
    r.add_argument("--events", required=True)
    policy_args(r)
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("--events", required=True)
    q.add_argument("--show", type=int, default=20)
    args = p.parse_args(argv)

    from lateflow.session import build_session

    spark = build_session(args.master)
    try:
        return {"stream": cmd_stream, "demo": cmd_demo, "replay": cmd_replay,
                "query": cmd_query}[args.cmd](spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    raise SystemExit(main())
