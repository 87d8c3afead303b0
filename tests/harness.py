"""Spark-vs-DuckDB comparison in the shape of the driver's correctness gate.

Run as a script to check every key at a scale factor:
    python tests/harness.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x).__name__) if x is not None else "", x if x is not None else 0)
                 for x in row)


def rows_by_name(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: repr(r))


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "DATE": "date", "BOOLEAN": "boolean", "FLOAT": "float", "SMALLINT": "smallint",
                 "TIMESTAMP": "timestamp_ntz", "HUGEINT": "hugeint"}


def duck_types(con, sql):
    rel = con.sql(sql)
    return {c: DUCK_TO_SPARK.get(str(t), str(t).lower()) for c, t in zip(rel.columns, rel.types)}


def compare(spark, con, name, fn, sql, sf_dir, tol=0.0):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    t2 = time.time()
    scols, s = rows_by_name(sdf.columns, srows)
    dcols2, d = rows_by_name(dcols, drows)
    msg = []
    stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    dtypes = duck_types(con, sql)
    bad_types = {c: (stypes.get(c), dtypes.get(c)) for c in stypes if stypes.get(c) != dtypes.get(c)}
    if bad_types:
        msg.append(f"types differ (spark, duck): {bad_types}")
    if scols != dcols2:
        msg.append(f"columns differ: spark={scols} duck={dcols2}")
    if len(s) != len(d):
        msg.append(f"rows differ: spark={len(s)} duck={len(d)}")
    elif not msg:
        bad = 0
        for a, b in zip(s, d):
            if a != b:
                if tol and all((x == y) or (isinstance(x, float) and isinstance(y, float)
                                            and abs(x - y) <= tol * max(1, abs(y))) for x, y in zip(a, b)):
                    continue
                bad += 1
                if bad <= 3:
                    msg.append(f"row differs:\n  spark={a}\n  duck ={b}")
        if bad:
            msg.append(f"{bad} rows differ")
    return (not msg), len(s), t1 - t0, t2 - t1, msg


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    import __spark_entry__ as E
    from cohortlens.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    ok_all = True
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            t0 = time.time()
            n = fn(spark, sf_dir).count()
            print(f"ROWS  {name:32s} rows={n} spark={time.time() - t0:.2f}s (no oracle)")
            continue
        try:
            ok, n, ts, td, msg = compare(spark, con, name, fn, sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, n, ts, td, msg = False, -1, 0, 0, [f"{type(e).__name__}: {str(e)[:800]}"]
        ok_all &= ok
        print(f"{'OK  ' if ok else 'FAIL'}  {name:32s} rows={n} spark={ts:.2f}s duck={td:.2f}s")
        for m in msg:
            print("      " + m)
    spark.stop()
    return 0 if ok_all else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
