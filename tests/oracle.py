"""Run registered queries next to their SQL and compare the rows.

    python -m tests.oracle [folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from tallygraph.session import TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        if value.is_integer() and abs(value) < 2**53:
            return int(value)
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if hasattr(value, "as_tuple"):
        return _plain(float(value))
    if isinstance(value, int):
        return value
    return str(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(db, sql: str, frame) -> str | None:
    """None when the rows agree, otherwise what differs."""
    got_names, got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    compare.spark_done = time.time()
    result = db.execute(sql)
    want_names, want = normal([d[0] for d in result.description], result.fetchall())
    if want_names != got_names:
        return f"columns {got_names} != {want_names}"
    if len(want) != len(got):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"first difference: got {str(g)[:300]} want {str(w)[:300]}"
    return None


def main(folder: str, names: list[str]) -> None:
    from tallygraph.queries import ORACLES, QUERIES
    from tallygraph.session import build_session

    spark = build_session("oracle", "local[8]", 8, spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    bad = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            if name in ORACLES:
                problem = compare(db, ORACLES[name], frame)
                rows = f"(sql {time.time() - compare.spark_done:.2f}s)"
            else:
                problem, rows = None, f"(rows only: {frame.count()})"
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.2f}s {'ok' if problem is None else problem} {rows}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01", sys.argv[2:])
