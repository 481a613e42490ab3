"""Local stand-in for the driver's correctness gate: run a registered query
on Spark and its SQL on DuckDB over the same parquet tables, then compare
row count, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import decimal
import hashlib
import math
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v else "NaN"
    return str(v)


def digest(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con=None) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    out = {"query": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        out["status"] = "rows-only"
        return out
    con = con or duck(sf_dir)
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out["duck_rows"] = len(d_rows)
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    out["hash_match"] = out["cols_match"] and digest(s_cols, s_rows) == digest(d_cols, d_rows)
    out["status"] = "ok" if (out["hash_match"] and len(s_rows) == len(d_rows)) else "MISMATCH"
    if out["status"] != "ok":
        out["spark_cols"] = s_cols
        out["duck_cols"] = d_cols
        a = set("|".join(_norm(v) for v in r) for r in s_rows)
        b = set("|".join(_norm(v) for v in r) for r in d_rows)
        out["only_spark"] = sorted(a - b)[:3]
        out["only_duck"] = sorted(b - a)[:3]
    return out


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from climastar.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session(8, 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if only and name not in only:
            continue
        try:
            r = compare(spark, sf_dir, name, fn, sqls.get(name), con)
        except Exception as e:  # report and continue
            r = {"query": name, "status": "ERROR", "error": repr(e)[:500]}
        bad += r["status"] in ("MISMATCH", "ERROR")
        print(r, flush=True)
    print(f"done: {len(qs)} queries, {bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
