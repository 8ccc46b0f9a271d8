"""Compare registered queries with their SQL on one table folder.

python tests/check.py [folder] [name part ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if hasattr(v, "quantize"):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}" if v != int(v) or abs(v) > 1e15 else str(int(v))
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """None when equal, else a short description."""
    got_names = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} != {sorted(want_names)}"
    a, b = rows_of(got_names, got), rows_of(want_names, want)
    if a == b:
        return None
    in_a, in_b = set(a), set(b)
    only_a, only_b = [r for r in a if r not in in_b][:2], [r for r in b if r not in in_a][:2]
    return f"rows {len(a)} vs {len(b)}; spark only {str(only_a)[:700]}; sql only {str(only_b)[:700]}"


def main() -> int:
    from pageloom.session import build_session
    from __spark_entry__ import oracle_sql, queries

    args = sys.argv[1:]
    folder = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        "spark.log.structuredLogging.enabled": "false",
    })
    spark.sparkContext.setLogLevel("OFF")
    con, oracles, bad = connect(folder), oracle_sql(), 0
    for name, fn in queries().items():
        if args and not any(a in name for a in args):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                n = ""
            else:
                problem, n = None, f"rows={df.count()} (no SQL)"
        except Exception as exc:
            problem, n = f"{type(exc).__name__}: {str(exc)[:900]}", ""
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - start:.1f}s {n}{problem or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(), 100))
