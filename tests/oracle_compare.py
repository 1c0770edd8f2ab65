"""Run queries() against oracle_sql() the way the driver does.

Usage: python tests/oracle_compare.py [sf_dir] [key ...]
Prints one line per query: rows, schema match, value-hash match.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    import datetime
    import decimal

    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(_norm(x)) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return str(v)


def fingerprint(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16], lines


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as entry
    from tally.session import get_session

    spark = get_session("local[8]", conf={"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for key in keys or list(qs):
        t0 = time.time()
        df = qs[key](spark, sf_dir)
        rows = [tuple(r) for r in df.collect()]
        cols = df.columns
        dt = time.time() - t0
        if key not in sql:
            print(f"{key:40s} rows={len(rows):6d} (no oracle) {dt:.1f}s")
            continue
        res = con.execute(sql[key])
        ocols = [d[0] for d in res.description]
        orows = res.fetchall()
        h1, l1 = fingerprint(cols, rows)
        h2, l2 = fingerprint(ocols, orows)
        ok = sorted(cols) == sorted(ocols) and len(rows) == len(orows) and h1 == h2
        bad += not ok
        print(f"{key:40s} rows={len(rows):6d}/{len(orows):6d} cols={'ok' if sorted(cols)==sorted(ocols) else (cols, ocols)} "
              f"hash={'ok' if h1 == h2 else 'MISMATCH'} {dt:.1f}s")
        if not ok and h1 != h2:
            s1, s2 = set(l1), set(l2)
            for x in sorted(s1 - s2)[:3]:
                print("   spark :", x)
            for x in sorted(s2 - s1)[:3]:
                print("   oracle:", x)
    print("FAILED" if bad else "ALL OK", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
