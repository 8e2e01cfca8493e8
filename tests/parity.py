"""Run registered queries next to their DuckDB statements and compare.

Used by ``tests/test_parity.py`` and runnable by hand:
``python tests/parity.py /root/testdata/sf0.01 [name ...]``.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, sf_dir: str, names=None, con=None):
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    report = {}
    for name in names or sorted(qs):
        t0 = time.time()
        df = qs[name](spark, sf_dir)
        srows = df.collect()
        t1 = time.time()
        entry = {"rows": len(srows), "spark_sec": round(t1 - t0, 2)}
        if name in sqls:
            rel = con.sql(sqls[name])
            drows = rel.fetchall()
            scols, dcols = df.columns, rel.columns
            entry["cols_match"] = sorted(scols) == sorted(dcols)
            entry["oracle_rows"] = len(drows)
            a = rows_of(scols, [tuple(r) for r in srows])
            b = rows_of(dcols, drows)
            diffs = sum(1 for x, y in zip(a, b) if x != y) + abs(len(a) - len(b))
            entry["diffs"] = diffs
            if diffs:
                first = next(((x, y) for x, y in zip(a, b) if x != y), None)
                entry["first_diff"] = repr(first)[:300]
        report[name] = entry
        print(name, entry, flush=True)
    return report


if __name__ == "__main__":
    from tessera import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    compare(spark, sf, sys.argv[2:] or None)
