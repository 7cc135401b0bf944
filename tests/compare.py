"""Run registered queries next to their SQL in DuckDB and compare whole results.

Usage: python tests/compare.py [--sf DIR] [--time] [name ...]
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def _norm(v):
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v + 0.0
    return v


def _kind(v) -> str:
    return type(v).__name__


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple(str(x) for x in t)
    )


def compare(spark, con, name: str, sf: str) -> tuple[bool, str]:
    from memberlytics.plans import ORACLES, QUERIES

    start = time.time()
    df = QUERIES[name](spark, sf)
    got_cols, got = rows_of(df.columns, df.collect())
    took = time.time() - start
    if name not in ORACLES:
        return False, f"rows={len(got)} cols={len(got_cols)} no SQL {took:.1f}s"
    res = con.execute(ORACLES[name])
    cols = [d[0] for d in res.description]
    want_cols, want = rows_of(cols, res.fetchall())
    info = f"rows={len(got)} cols={len(got_cols)} {took:.1f}s"
    if got_cols != want_cols:
        return False, f"{info} columns differ: {sorted(set(got_cols) ^ set(want_cols))}"
    if len(got) != len(want):
        return False, f"{info} row count {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        for c, a, b in zip(got_cols, g, w):
            if a != b or (a is not None and _kind(a) != _kind(b)):
                return False, f"{info} column {c}: spark {a!r} sql {b!r}\n   {g[:12]}\n   {w[:12]}"
    return True, info


def main(argv: list[str]) -> int:
    from memberlytics.plans import QUERIES
    from memberlytics.session import build_session

    sf = "/root/testdata/sf0.01"
    if "--sf" in argv:
        i = argv.index("--sf")
        sf = argv[i + 1]
        del argv[i : i + 2]
    names = argv or list(QUERIES)
    names = [n for n in QUERIES if any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in names)]
    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    bad = []
    for n in names:
        try:
            ok, info = compare(spark, con, n, sf)
        except Exception as e:  # noqa: BLE001
            ok, info = False, f"{type(e).__name__}: {str(e)[:1500]}"
        print("ok  " if ok else "FAIL", n, info, flush=True)
        if not ok:
            bad.append(n)
    print(f"{len(names) - len(bad)} of {len(names)} agree; failing: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
