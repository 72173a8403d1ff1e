"""Run registered queries in Spark and their DuckDB oracle side by side.

Comparison: row count, column names, and an order-insensitive hash of the rows
(floats rounded to 6 places). Usable from pytest and as a script:

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def digest(cols, rows) -> str:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
    return h.hexdigest()


def compare(spark, name, fn, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = list(sdf.columns)
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    out = {
        "query": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
        "cols_match": sorted(s_cols) == sorted(d_cols),
        "spark_cols": s_cols, "oracle_cols": d_cols, "spark_sec": round(t1 - t0, 2),
    }
    out["hash_match"] = out["cols_match"] and digest(s_cols, s_rows) == digest(d_cols, d_rows)
    out["ok"] = out["hash_match"] and len(s_rows) == len(d_rows)
    if not out["ok"] and out["cols_match"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        ss = {repr(tuple(_norm(r[i]) for i in order_s)) for r in s_rows}
        dd = {repr(tuple(_norm(r[i]) for i in order_d)) for r in d_rows}
        out["only_spark"] = sorted(ss - dd)[:3]
        out["only_oracle"] = sorted(dd - ss)[:3]
    return out


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from skein.session import get_spark
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_spark("local[8]", shuffle_partitions=8, **{"spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("OFF")
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        if name not in sqls:
            print(f"{name}: no oracle (rows-only)")
            continue
        try:
            r = compare(spark, name, qs[name], sqls[name], sf_dir, con)
        except Exception as e:  # report and continue
            print(f"{name}: ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        flag = "OK " if r["ok"] else "BAD"
        bad += not r["ok"]
        print(f"{flag} {name}: {r['spark_rows']} vs {r['oracle_rows']} rows, {r['spark_sec']}s"
              + ("" if r["ok"] else f" cols={r['spark_cols']} / {r['oracle_cols']} "
                 f"only_spark={r.get('only_spark')} only_oracle={r.get('only_oracle')}"))
    print(f"{bad} failing")


if __name__ == "__main__":
    main(sys.argv[1:])
