"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
Prints one line per query: name, rows (spark/duckdb), and a verdict.
"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_multiset(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


def duck_connection(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, sf_dir, name, query, sql, con):
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    same_cols = sorted(s_cols) == sorted(d_cols)
    same_vals = same_cols and rows_multiset(s_cols, s_rows) == rows_multiset(d_cols, d_rows)
    return {
        "name": name,
        "spark_rows": len(s_rows),
        "duck_rows": len(d_rows),
        "columns_match": same_cols,
        "values_match": same_vals,
        "spark_sec": round(t1 - t0, 2),
        "cols": (s_cols, d_cols) if not same_cols else None,
    }


def main(argv):
    from placeseek.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry

    spark = local_session(8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck_connection(sf_dir)
    bad = 0
    for name, q in qs.items():
        if names and name not in names:
            continue
        if name not in sqls:
            df = q(spark, sf_dir)
            print(f"{name:28s} rows-only {df.count()}")
            continue
        try:
            r = compare(spark, sf_dir, name, q, sqls[name], con)
        except Exception as e:  # noqa: BLE001 - report and go on
            bad += 1
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:300]}")
            continue
        ok = r["columns_match"] and r["values_match"] and r["spark_rows"] == r["duck_rows"]
        bad += not ok
        print(
            f"{name:28s} {'OK ' if ok else 'BAD'} rows {r['spark_rows']}/{r['duck_rows']} "
            f"{r['spark_sec']}s {r['cols'] or ''}"
        )
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
