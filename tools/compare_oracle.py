"""Run every registered query in Spark and its oracle SQL in DuckDB; compare results.

    python tools/compare_oracle.py [--loose] [sf_dir] [name ...]

Compares row count, column names and the multiset of rows: floats exactly, NaN for itself
(--loose: to 9 significant digits, NaN as null). Prints one line per query and exits non-zero on any mismatch.
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


EXACT = True


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN" if EXACT else None
        return v if EXACT else float(f"{v:.9g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, Counter(tuple(_norm(r[c]) for c in cols) for r in df.collect())


def rows_of_duck(rel):
    cols = list(rel.columns)
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = Counter(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())
    return sorted(cols), out


def duck_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True):
    from lateflow.queries import SPARK, SQL

    con = duck_connection(sf_dir)
    results = {}
    for name in names or list(SPARK):
        t0 = time.time()
        try:
            scols, srows = rows_of_spark(SPARK[name](spark, sf_dir))
        except Exception as exc:  # report and continue
            results[name] = f"SPARK ERROR {type(exc).__name__}: {str(exc)[:300]}"
            print(f"{name:24} {results[name]}", flush=True)
            continue
        ts = time.time() - t0
        if name not in SQL:
            results[name] = f"rows-only {sum(srows.values())}"
            print(f"{name:24} {results[name]}  spark {ts:.1f}s", flush=True)
            continue
        try:
            dcols, drows = rows_of_duck(con.sql(SQL[name]))
        except Exception as exc:
            results[name] = f"SQL ERROR {str(exc)[:300]}"
            print(f"{name:24} {results[name]}", flush=True)
            continue
        n_s, n_d = sum(srows.values()), sum(drows.values())
        if scols != dcols:
            status = f"COLUMNS differ spark={scols} sql={dcols}"
        elif n_s != n_d:
            status = f"ROWS differ spark={n_s} sql={n_d}"
        elif srows != drows:
            only_s = list((srows - drows).items())[:3]
            only_d = list((drows - srows).items())[:3]
            status = f"VALUES differ spark-only={only_s} sql-only={only_d}"
        else:
            status = f"OK {n_s} rows"
        results[name] = status
        if verbose:
            print(f"{name:24} {status}  spark {ts:.1f}s", flush=True)
    return results


def main(argv):
    from lateflow.session import build_session

    global EXACT
    if "--loose" in argv:
        EXACT = False
        argv = [a for a in argv if a != "--loose"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or None
    spark = build_session("local[8]", 8)
    res = compare(spark, sf_dir, names)
    bad = [n for n, s in res.items() if not (s.startswith("OK") or s.startswith("rows-only"))]
    print(f"{len(res) - len(bad)}/{len(res)} ok; failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
