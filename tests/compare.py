"""Compare queries with their SQL, as multisets of rows."""

from __future__ import annotations

import datetime
import decimal
import math
import time
from collections import Counter

import duckdb

from checks.common import TABLES


def connect(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, fn, sql, sf):
    """(problem or None, rows, seconds)"""
    start = time.time()
    df = fn(spark, sf)
    got = df.collect()
    seconds = time.time() - start
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got), seconds
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        return (f"{len(got)} rows vs {len(want)}; only in Spark {list((a - b).items())[:2]}; "
                f"only in SQL {list((b - a).items())[:2]}"), len(got), seconds
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    kinds = {d[0]: str(d[1]) for d in cur.description}
    loose = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
             "date": "DATE", "timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT"}
    off = [f"{n}: {t} vs {kinds[n]}" for n, t in types.items() if loose.get(t, kinds[n]) != kinds[n]]
    return ("types " + "; ".join(off) if off else None), len(got), seconds


if __name__ == "__main__":
    import sys

    from checks import REGISTRY
    from tidemark.session import local_session
    sf = sys.argv[1]
    wanted = sys.argv[2:]
    spark, con = local_session(8), connect(sf)
    bad = 0
    for name, (fn, sql) in REGISTRY.items():
        if wanted and name not in wanted:
            continue
        try:
            problem, n, seconds = compare(spark, con, fn, sql, sf)
        except Exception as error:
            problem, n, seconds = f"{type(error).__name__}: {str(error)[:600]}", -1, 0.0
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {name:34s} {n:8d} {seconds:6.2f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
