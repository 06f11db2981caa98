"""Runs registered queries in Spark and their SQL in DuckDB and compares the rows."""
from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, dt.datetime) and v.tzinfo:
        return v.replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(norm(x) for x in v.values())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


SPARK_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def check(spark, con, sf_dir, key, queries, oracles) -> str | None:
    """None when both agree, else a description."""
    df = queries[key](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if key not in oracles:
        return None if got else "no rows"
    cur = con.execute(oracles[key])
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = [
        (n, t, types[n]) for n, t in df.dtypes if SPARK_KINDS.get(t, types[n]) != types[n]
    ]
    if kinds:
        return f"types {kinds}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        only_a, only_b = sorted(sa - sb), sorted(sb - sa)
        return f"rows {len(a)} vs {len(b)}, differ {len(only_a)}/{len(only_b)}\n   spark {only_a[:3]}\n   sql   {only_b[:3]}"
    return None if got else "no rows"


def main(argv):
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "12g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    q, o = entry.queries(), entry.oracle_sql()
    keys = [k for k in q if not argv or any(k == a or (a.endswith("*") and k.startswith(a[:-1])) for a in argv)]
    bad = 0
    for key in keys:
        t = time.time()
        try:
            res = check(spark, con, sf_dir, key, q, o)
        except Exception as e:
            res = f"{type(e).__name__}: {str(e)[:600]}"
            if os.environ.get("TRACE"):
                traceback.print_exc()
        took = time.time() - t
        bad += res is not None
        tag = "ok  " if res is None else "FAIL"
        print(f"{tag} {key:28s} {took:6.2f}s {'sql' if key in o else 'rows'} {res or ''}", flush=True)
    print(f"{len(keys)} queries, {bad} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
