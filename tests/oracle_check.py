"""Run registered queries in Spark and their SQL twins in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]

Comparison: column names (sorted), row count, and the multiset of rows with
values normalised (integers as int, DATE as ISO text, DECIMAL/float as
float, NaN as NULL).  Floats must match exactly.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_key(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in rows]


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    t2 = time.time()
    problems = []
    if sorted(s_cols) != sorted(d_cols):
        problems.append(f"columns spark={sorted(s_cols)} duck={sorted(d_cols)}")
    elif len(s_rows) != len(d_rows):
        problems.append(f"rows spark={len(s_rows)} duck={len(d_rows)}")
    else:
        a, b = Counter(rows_key(s_cols, s_rows)), Counter(rows_key(d_cols, d_rows))
        if a != b:
            only_a = list((a - b).elements())[:3]
            only_b = list((b - a).elements())[:3]
            problems.append(f"values differ: spark-only {only_a} duck-only {only_b}")
    status = "OK" if not problems else "FAIL"
    print(f"{status:4} {name:30} rows={len(s_rows):7d} spark={t1 - t0:5.1f}s duck={t2 - t1:5.1f}s "
          + "; ".join(problems)[:1500], flush=True)
    return not problems


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and "/" in argv[1] else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if "/" not in a]
    from fleetzone.session import local_session
    import __spark_entry__ as E
    spark = local_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    names = keys or sorted(qs)
    bad = []
    for n in names:
        if n not in sqls:
            print(f"SKIP {n:30} (no oracle SQL)")
            continue
        try:
            if not compare(spark, con, n, qs[n], sqls[n], sf_dir):
                bad.append(n)
        except Exception as e:  # report and continue
            print(f"ERR  {n:30} {type(e).__name__}: {str(e)[:800]}", flush=True)
            bad.append(n)
    print(f"{len(names) - len(bad)}/{len(names)} passed; failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
