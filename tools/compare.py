"""Run queries on Spark and their check text on DuckDB, and compare the results.

usage: python tools/compare.py [--sf 0.01] [--module m] [ids...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from tallyframe.plans import registry  # noqa: E402
from tallyframe.session import local_session  # noqa: E402
from tallyframe.sources.tables import TABLE_NAMES  # noqa: E402


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


def kind(dtype: str) -> str:
    d = dtype.lower()
    if d in ("tinyint", "smallint", "int", "integer"):
        return "int"
    if d in ("bigint", "long"):
        return "bigint"
    if d.startswith(("varchar", "string")):
        return "string"
    if d in ("float", "real"):
        return "float"
    return d


def cell(v):
    if v is None:
        return ("~",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return ("n", repr(v + 0.0 if v != 0 else 0.0))
    if isinstance(v, bool):
        return ("b", str(v))
    if isinstance(v, int):
        return ("n", repr(v))
    return ("s", str(v))


def compare(cols_a, rows_a, cols_b, rows_b) -> str:
    a = [c for c, _ in cols_a]
    b = [c for c, _ in cols_b]
    if sorted(a) != sorted(b):
        return f"columns {sorted(a)} vs {sorted(b)}"
    ka, kb = dict(cols_a), dict(cols_b)
    bad = [f"{c}:{ka[c]}/{kb[c]}" for c in a if kind(ka[c]) != kind(kb[c])]
    if bad:
        return "types " + ", ".join(bad)
    if len(rows_a) != len(rows_b):
        return f"rows {len(rows_a)} vs {len(rows_b)}"
    order = sorted(a)
    ia, ib = [a.index(c) for c in order], [b.index(c) for c in order]
    sa = sorted(tuple(cell(r[i]) for i in ia) for r in rows_a)
    sb = sorted(tuple(cell(r[i]) for i in ib) for r in rows_b)
    diff = [(x, y) for x, y in zip(sa, sb) if x != y]
    if diff:
        x, y = diff[0]
        return f"{len(diff)} rows differ, first {[(c, p[-1], q[-1]) for c, p, q in zip(order, x, y) if p != q][:4]}"
    return ""


def check(spark, con, name: str, folder: str) -> tuple[str, float, int]:
    t0 = time.time()
    df = registry.QUERIES[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    sec = time.time() - t0
    if name not in registry.ORACLES:
        return ("" if rows else "no rows"), sec, len(rows)
    cur = con.execute(registry.ORACLES[name])
    cols_b = [(d[0], str(d[1])) for d in cur.description]
    return compare(df.dtypes, rows, cols_b, cur.fetchall()), sec, len(rows)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="0.01")
    ap.add_argument("--module")
    ap.add_argument("ids", nargs="*")
    args = ap.parse_args()
    if args.module:
        import importlib

        for m in args.module.split(","):
            importlib.import_module(f"tallyframe.plans.{m}")
    else:
        registry.load_all()
    folder = f"/root/testdata/sf{args.sf}"
    spark = local_session("8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in args.ids or list(registry.QUERIES):
        try:
            msg, sec, n = check(spark, con, name, folder)
        except Exception as e:  # noqa: BLE001
            msg, sec, n = f"{type(e).__name__}: {str(e)[:600]}", 0.0, 0
            if os.environ.get("TB"):
                traceback.print_exc()
        failed += bool(msg)
        tag = "FAIL" if msg else ("ok  " if name in registry.ORACLES else "rows")
        print(f"{tag} {name:26s} {sec:6.2f}s {n:7d} {msg}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main()
