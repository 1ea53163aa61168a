"""Compare registered jobs with their DuckDB oracle on one scale factor.

    python -m fleetlens.plans.check [--sf-dir DIR] [name-prefix ...]

Same checks as the correctness gate: column names, row count and an
order-insensitive comparison of values (doubles to 6 significant decimals).
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import math
import sys
import time

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create or replace view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if isinstance(v, bool):
        return v
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, con, name, job, sql, sf_dir):
    t0 = time.time()
    sdf = job(spark, sf_dir)
    srows = sdf.collect()
    scols = sdf.columns
    t1 = time.time()
    if sql is None:
        return dict(name=name, ok=None, rows=len(srows), spark_s=round(t1 - t0, 2), note="no oracle")
    res = con.execute(sql)
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    if sorted(scols) != sorted(dcols):
        return dict(name=name, ok=False, note=f"columns spark={scols} duck={dcols}")
    if len(srows) != len(drows):
        return dict(name=name, ok=False, note=f"rows spark={len(srows)} duck={len(drows)}")
    a, b = _rows(scols, srows), _rows(dcols, drows)
    for x, y in zip(a, b):
        if x != y:
            return dict(name=name, ok=False, note=f"first diff spark={x} duck={y}")
    return dict(name=name, ok=True, rows=len(srows), spark_s=round(t1 - t0, 2))


def main(argv=None):
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    sys.path.insert(0, ".")
    from fleetlens.plans.registry import ORACLE, QUERIES, load_all
    from fleetlens.session import build_session
    load_all()
    spark = build_session("local[8]")
    con = duck(a.sf_dir)
    bad = 0
    for name, job in QUERIES.items():
        if a.names and not any(name.startswith(p) for p in a.names):
            continue
        try:
            r = compare(spark, con, name, job, ORACLE.get(name), a.sf_dir)
        except Exception as e:  # report and go on
            r = dict(name=name, ok=False, note=f"{type(e).__name__}: {str(e)[:400]}")
        bad += r.get("ok") is False
        print(("OK  " if r.get("ok") else "--  " if r.get("ok") is None else "BAD ") + str(r), flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
