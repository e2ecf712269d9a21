"""Run registered queries on Spark and their oracle SQL on DuckDB; compare results.

    python scripts/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from tessera.plans.registry import load_all  # noqa: E402
from tessera.plans.views import TABLES, Views  # noqa: E402
from tessera.session import local_session  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict())
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    spark = local_session(8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    reg = load_all()
    bad = 0
    for name, q in reg.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = q.fn(Views(spark, sf_dir))
            cols = sorted(df.columns)
            got = [tuple(norm(r[c]) for c in cols) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if q.sql is None:
            print(f"rows {name}: {len(got)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(q.sql)
            ocols = [d[0] for d in res.description]
            rows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(ocols) != cols:
            print(f"FAIL {name}: columns spark={cols} oracle={sorted(ocols)}")
            bad += 1
            continue
        idx = [ocols.index(c) for c in cols]
        exp = [tuple(norm(r[i]) for i in idx) for r in rows]
        g, e = sorted(got, key=key), sorted(exp, key=key)
        if g != e:
            bad += 1
            gs, es = set(map(repr, g)), set(map(repr, e))
            print(f"FAIL {name}: rows spark={len(g)} oracle={len(e)}; "
                  f"only spark {sorted(gs - es)[:3]} only oracle {sorted(es - gs)[:3]}")
        else:
            print(f"ok   {name}: {len(g)} rows {ts:.1f}s")
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
