"""Run registered queries against their DuckDB oracles (as the driver does).

    python tests/oracle_check.py [sf_dir] [query ...]
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, name, fn, sql, con, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    ocols = rel.columns
    orows = rel.fetchall()
    ok_cols = sorted(cols) == sorted(ocols)
    h1, l1 = digest(rows, cols)
    h2, l2 = digest(orows, ocols)
    ok = ok_cols and len(rows) == len(orows) and h1 == h2
    detail = ""
    if not ok:
        detail = f" cols={sorted(cols)} vs {sorted(ocols)}"
        s1, s2 = set(l1), set(l2)
        detail += f"\n   spark-only {list(s1 - s2)[:3]}\n   oracle-only {list(s2 - s1)[:3]}"
    print(f"{'OK ' if ok else 'BAD'} {name}: rows {len(rows)}/{len(orows)} {t1 - t0:.2f}s{detail}", flush=True)
    return ok


def main():
    import __spark_entry__ as E
    from tollstream.session import build_session
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    if os.environ.get("ORACLE_PLAIN_SESSION"):
        from pyspark.sql import SparkSession  # a session this package did not configure
        spark = SparkSession.builder.master("local[8]").getOrCreate()
    else:
        spark = build_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = []
    for name, fn in qs.items():
        if only and name not in only:
            continue
        if name not in sqls:
            print(f"-- {name}: no oracle (rows only): {fn(spark, sf_dir).count()} rows")
            continue
        try:
            if not compare(spark, name, fn, sqls[name], con, sf_dir):
                bad.append(name)
        except Exception as e:  # report and go on
            print(f"ERR {name}: {type(e).__name__}: {str(e)[:400]}", flush=True)
            bad.append(name)
    print("FAILED:", bad if bad else "none")
    spark.stop()
    sys.exit(1 if bad else 0)


if __name__ == "__main__":
    main()
