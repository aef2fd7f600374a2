"""Run each registered query in Spark and its oracle SQL in DuckDB; compare
row counts, column names and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import sys

import duckdb

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 2):.2f}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.2f}"
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256()
    for line in lines:
        h.update(line.encode())
        h.update(b"\n")
    return h.hexdigest(), lines


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir, names=None, show=3):
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as e
    qs, sqls = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name, fn in qs.items():
        if names and name not in names:
            continue
        df = fn(spark, sf_dir)
        s_cols = df.columns
        s_rows = [tuple(r) for r in df.collect()]
        if name not in sqls:
            results[name] = ("rows-only", len(s_rows))
            print(f"{name:28s} rows-only {len(s_rows)}")
            continue
        cur = con.execute(sqls[name])
        d_cols = [c[0] for c in cur.description]
        d_rows = cur.fetchall()
        hs, ls = digest(s_cols, s_rows)
        hd, ld = digest(d_cols, d_rows)
        ok = sorted(s_cols) == sorted(d_cols) and len(s_rows) == len(d_rows) and hs == hd
        results[name] = ok
        print(f"{name:28s} {'OK ' if ok else 'BAD'} spark={len(s_rows)} duck={len(d_rows)}"
              + ("" if sorted(s_cols) == sorted(d_cols) else f" cols {sorted(s_cols)} vs {sorted(d_cols)}"))
        if not ok:
            a, b = set(ls), set(ld)
            for x in sorted(a - b)[:show]:
                print("   spark only:", x)
            for x in sorted(b - a)[:show]:
                print("   duck  only:", x)
    return results


if __name__ == "__main__":
    from pyspark.sql import SparkSession
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or None
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, names)
    bad = [k for k, v in res.items() if v is False]
    print("BAD:", bad)
