"""Run each registered query in Spark and its oracle SQL in DuckDB on the
same parquet tables; compare row count, column names and sorted values.

usage: python tools/oracle_check.py [--exact] [sf_dir] [query ...]

Doubles are compared after rounding to 9 places; with ``--exact`` they must
be equal bit for bit.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


EXACT = False


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        if EXACT:
            return (1, v.hex())
        return (1, repr(round(v, 9)) if math.isfinite(v) else repr(v))
    if hasattr(v, "item"):
        v = v.item()
    return (1, repr(v))


def rows_of(records, cols):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [r.asDict() for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    t2 = time.time()
    scols = sorted(sdf.columns)
    ok_cols = scols == sorted(dcols)
    ok_n = len(srows) == len(drows)
    ok_v = ok_cols and rows_of(srows, scols) == rows_of(drows, scols)
    status = "OK " if (ok_cols and ok_n and ok_v) else "BAD"
    print(f"{status} {name}: spark {len(srows)} rows {t1-t0:.1f}s | duck {len(drows)} rows "
          f"{t2-t1:.1f}s | cols {'=' if ok_cols else set(scols) ^ set(dcols)} values {ok_v}",
          flush=True)
    if not ok_v and ok_cols:
        a, b = rows_of(srows, scols), rows_of(drows, scols)
        sa, sb = set(a), set(b)
        print("   spark-only:", [dict(zip(scols, r)) for r in list(sa - sb)[:2]])
        print("   duck-only: ", [dict(zip(scols, r)) for r in list(sb - sa)[:2]])
    return status == "OK "


def main(argv):
    global EXACT
    if "--exact" in argv:
        EXACT = True
        argv = [a for a in argv if a != "--exact"]
    sys.path.insert(0, ".")
    from sitegauge.oracle_sql import SQL
    from sitegauge.registry import QUERIES
    from sitegauge.session import build_session
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    spark = build_session()
    con = duck(sf_dir)
    bad = []
    for n in names:
        try:
            if not compare(spark, con, n, QUERIES[n], SQL[n], sf_dir):
                bad.append(n)
        except Exception as e:  # noqa: BLE001 - report and continue
            print(f"ERR {n}: {type(e).__name__}: {str(e)[:800]}", flush=True)
            bad.append(n)
    print("FAILED:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
