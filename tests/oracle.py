"""Compare the catalogue with its SQL counterparts: ``python tests/oracle.py [sf_dir] [name...]``."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET threads TO 4")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    """A comparable, type-preserving form of a cell."""
    if isinstance(value, float) and math.isnan(value):
        return ("nan",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, (list, tuple)):
        return ("list", tuple(plain(v) for v in value))
    if value is None:
        return ("null",)
    return (type(value).__name__, value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def compare(spark, con, sf_dir, name, fn, sql) -> tuple[str, float]:
    """'' when both agree, else the first difference; with the Spark seconds."""
    start = time.time()
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return ("" if got else "no rows"), took
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want_cols, want = sorted_rows(names, cur.fetchall())
    got_cols, mine = sorted_rows(df.columns, got)
    if want_cols != got_cols:
        return f"columns {got_cols} != {want_cols}", took
    same = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    for col, kind in df.dtypes:
        if kind in same and not kinds[col].startswith(same[kind]):
            return f"type of {col}: {kind} != {kinds[col]}", took
    if len(want) != len(mine):
        return f"rows {len(mine)} != {len(want)}", took
    for a, b in zip(mine, want):
        if a != b:
            return f"{got_cols}: {a} != {b}", took
    return ("" if mine else "no rows"), took


def main() -> int:
    from sparktab.session import local_session

    import __spark_entry__ as e

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(sf_dir)
    oracles, bad = e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if args and name not in args:
            continue
        try:
            diff, took = compare(spark, con, sf_dir, name, fn, oracles.get(name))
        except Exception as exc:  # noqa: BLE001
            diff, took = f"{type(exc).__name__}: {str(exc)[:1500]}", 0.0
        bad += bool(diff)
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if diff else 'ok':5}{kind:5}{took:7.2f}s  {name}  {diff}", flush=True)
    spark.stop()
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
