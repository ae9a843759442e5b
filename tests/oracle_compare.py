"""Run registered queries in Spark and their SQL in DuckDB; compare row
count, column names and the multiset of rows (order-insensitive)."""

from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetbook.sources.tables import TEST_TABLES  # noqa: E402


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, Decimal):
        return format(v.normalize(), "f") if v != 0 else "0"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def rows_key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TEST_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name: str, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    out = {"name": name, "spark_rows": len(srows), "oracle_rows": len(drows),
           "cols_match": sorted(scols) == sorted(dcols)}
    out["values_match"] = out["cols_match"] and rows_key(srows, scols) == rows_key(drows, dcols)
    if not out["cols_match"]:
        out["spark_cols"], out["oracle_cols"] = scols, dcols
    return out


if __name__ == "__main__":
    from fleetbook.registry import ORACLE, QUERIES
    from fleetbook.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session()
    con = duck(sf)
    bad = 0
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        if name not in ORACLE:
            n = fn(spark, sf).count()
            print(f"{name:32s} rows={n} (no oracle)")
            continue
        try:
            r = compare(spark, name, fn, ORACLE[name], sf, con)
        except Exception as e:  # report and continue
            bad += 1
            print(f"{name:32s} ERROR {type(e).__name__}: {str(e)[:300]}")
            continue
        ok = r["values_match"]
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} spark={r['spark_rows']} oracle={r['oracle_rows']}"
              + ("" if r["cols_match"] else f" cols {r.get('spark_cols')} vs {r.get('oracle_cols')}"))
    print("mismatches:", bad)
