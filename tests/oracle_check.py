"""Compare registered queries with their SQL on the test tables.

``python -m tests.oracle_check [--sf 0.01] [name ...]``
"""

from __future__ import annotations

import argparse
import math
import time

import duckdb
import pandas as pd

from intentloom.plans import load_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(value: object) -> object:
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value.item() if hasattr(value, "item") else value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [tuple(_plain(v) for v in row) for row in frame.itertuples(index=False)]
    return sorted(rows, key=repr)


def differences(spark, con, sf_dir: str, name: str, limit: int = 3) -> list[str]:
    """Empty when the query and its SQL agree in columns, types, rows and values."""
    queries, oracles = load_queries()
    got = queries[name](spark, sf_dir).toPandas()
    want = con.sql(oracles[name]).df()
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} != {sorted(want.columns)}"]
    out = [
        f"type of {c}: {got[c].dtype} != {want[c].dtype}"
        for c in got.columns
        if got[c].dtype.kind != want[c].dtype.kind or got[c].dtype.itemsize != want[c].dtype.itemsize
    ]
    a, b = rows_of(got), rows_of(want)
    if len(a) != len(b):
        out.append(f"rows {len(a)} != {len(b)}")
    if a != b:
        only_a, only_b = sorted(set(a) - set(b), key=repr), sorted(set(b) - set(a), key=repr)
        out.append(f"{len(only_a)} / {len(only_b)} rows differ")
        out += [f"  spark {r!r}" for r in only_a[:limit]] + [f"  sql   {r!r}" for r in only_b[:limit]]
    if not len(a):
        out.append("no rows")
    return out


def main() -> int:
    from intentloom.session import local_session

    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="0.01")
    args.add_argument("names", nargs="*")
    opts = args.parse_args()
    sf_dir = f"/root/testdata/sf{opts.sf}"
    queries, oracles = load_queries()
    spark, con = local_session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in opts.names or queries:
        started = time.perf_counter()
        try:
            if name in oracles:
                problems = differences(spark, con, sf_dir, name)
            else:
                problems = [] if queries[name](spark, sf_dir).toPandas().shape[0] else ["no rows"]
        except Exception as failure:  # noqa: BLE001
            problems = [f"{type(failure).__name__}: {str(failure)[:1500]}"]
        bad += bool(problems)
        seconds = time.perf_counter() - started
        print(f"{'BAD' if problems else 'ok '} {seconds:6.2f}s {name}", flush=True)
        for p in problems:
            print("     ", p)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
