"""Compare registered queries with their SQL counterparts: `python -m checks.compare sf0.01 [name ...]`."""

from __future__ import annotations

import math
import sys
import tempfile
import time

import duckdb

from platterflow.session import local_session

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def canonical(value):
    if hasattr(value, "as_tuple"):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, bool):
        return value
    if isinstance(value, int):
        return float(value)
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(canonical(row[i]) for i in order) for row in rows], key=repr)


def main(scale: str, *names: str) -> int:
    from checks.oracles import ORACLES
    from checks.registry import QUERIES

    folder = f"/root/testdata/{scale}"
    sql = duckdb.connect()
    for name in TABLES:
        sql.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    spark = local_session("compare", tempfile.mkdtemp(prefix="compare-"), "8")
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            got = rows_of(frame.columns, frame.collect())
            took = time.time() - start
            if name not in ORACLES:
                print(f"{name:32s} {took:6.1f}s rows={len(got)} (no SQL)", flush=True)
                continue
            cursor = sql.execute(ORACLES[name])
            columns = [d[0] for d in cursor.description]
            want = rows_of(columns, cursor.fetchall())
        except Exception as error:  # report and go on with the next query
            bad += 1
            print(f"{name:32s} ERROR {type(error).__name__}: {str(error)[:600]}", flush=True)
            continue
        same = sorted(columns) == sorted(frame.columns) and got == want
        bad += not same
        print(f"{name:32s} {took:6.1f}s {'ok' if same else 'DIFFERS'} rows={len(got)}/{len(want)}", flush=True)
        if sorted(columns) != sorted(frame.columns):
            print("   columns", sorted(set(columns) ^ set(frame.columns)), flush=True)
        elif not same:
            pairs = [(g, w) for g, w in zip(got, want) if g != w][:2]
            print("   ", sorted(columns), *[f"\n    spark {g}\n    sql   {w}" for g, w in pairs], flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
