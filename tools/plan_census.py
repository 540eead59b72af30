"""Plan census: for every registered query, count exchanges and join strategies.

    python tools/plan_census.py [sf_dir]

Looks at the physical plan of each query and of every intermediate table that it writes (a
step that queries share counts for the first of them), and prints one line per query: hash / range / single-
partition exchanges, broadcasts, sort-merge joins, nested-loop or cartesian joins, windows,
and scans of the events. Single-partition exchanges must only feed bounded metadata (block carries,
per-day or per-commit tables, top-k merges); nested-loop and cartesian joins must not
appear at all. Queries that run micro-batches are left out: their own plan only reads what
these wrote.
"""

from __future__ import annotations

import re
import sys
from contextlib import contextmanager
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

PATTERNS = {
    "hash_x": r"Exchange hashpartitioning",
    "range_x": r"Exchange rangepartitioning",
    "single_x": r"Exchange SinglePartition",
    "bcast": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "nlj": r"BroadcastNestedLoopJoin|CartesianProduct",
    "window": r"\bWindow\b",
    "events": r"FileScan parquet .*events\.parquet",
}


@contextmanager
def written_plans():
    """Collects the physical plans of the intermediate tables written meanwhile."""
    from lateflow.plans import scan

    plans, write = [], scan._write

    def noting(df, path):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path)

    scan._write = noting
    try:
        yield plans
    finally:
        scan._write = write


def census(spark, sf_dir: str) -> dict[str, dict[str, int]]:
    from lateflow import queries
    from lateflow.stream_queries import STREAMED

    out = {}
    queries.forget()
    for name, fn in queries.SPARK.items():
        if name in STREAMED:
            continue
        with written_plans() as plans:
            plans.append(fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString())
        text = "\n".join(plans)
        out[name] = {k: len(re.findall(p, text)) for k, p in PATTERNS.items()}
    return out


def main(argv):
    from lateflow.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    res = census(spark, sf_dir)
    keys = list(PATTERNS)
    print(f"{'query':24} " + " ".join(f"{k:>8}" for k in keys))
    for name, c in res.items():
        print(f"{name:24} " + " ".join(f"{c[k]:>8}" for k in keys))
    bad = [n for n, c in res.items() if c["nlj"]]
    print("nested-loop / cartesian joins:", bad or "none")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
