"""Compare registered queries with their DuckDB text.

python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter
from decimal import Decimal

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, Decimal):
        return format(v.normalize(), "f")
    if hasattr(v, "tzinfo") and getattr(v, "tzinfo", None) is not None:
        return v.replace(tzinfo=None)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(cell(r[i]) for i in order) for r in data)


def compare(spark, con, name, run, sql, sf_dir):
    t0 = time.time()
    df = run(spark, sf_dir)
    got = rows(df.columns, df.collect())
    t1 = time.time()
    if sql is None:
        return f"rows-only {sum(got[1].values())}", t1 - t0, 0.0, True
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows(names, cur.fetchall())
    t2 = time.time()
    if got == want:
        return f"ok {sum(got[1].values())}", t1 - t0, t2 - t1, True
    extra = list((got[1] - want[1]).items())[:3]
    lost = list((want[1] - got[1]).items())[:3]
    return (
        f"MISMATCH cols {got[0] == want[0]} {got[0] if got[0] != want[0] else ''} {want[0] if got[0] != want[0] else ''} "
        f"rows {sum(got[1].values())} vs {sum(want[1].values())}\n   spark only {str(extra)[:700]}\n   duck only {str(lost)[:700]}",
        t1 - t0,
        t2 - t1,
        False,
    )


def main() -> int:
    from marketloom.session import local_session

    import __spark_entry__ as e

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(e.queries())
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf_dir), []
    for name in wanted:
        try:
            text, s, d, ok = compare(spark, con, name, e.queries()[name], e.oracle_sql().get(name), sf_dir)
        except Exception as error:  # report every query
            text, s, d, ok = f"ERROR {type(error).__name__} {str(error)[:900]}", 0, 0, False
        print(f"{name:28s} spark {s:6.2f}s duck {d:6.2f}s  {text}", flush=True)
        if not ok:
            bad.append(name)
    print(len(wanted), "queries,", len(bad), "failing:", bad)
    return bool(bad)


if __name__ == "__main__":
    raise SystemExit(main())
