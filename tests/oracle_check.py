"""Runs registered queries next to their SQL counterparts.

``python tests/oracle_check.py [sf] [name-prefix ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
DATA = os.environ.get("TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, datetime.datetime) and value.tzinfo is not None:
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def kind(type_name: str) -> str:
    t = str(type_name).upper()
    if t in ("INTEGER", "INT", "TINYINT", "SMALLINT", "BYTE", "SHORT"):
        return "int"
    if t in ("BIGINT", "LONG", "HUGEINT"):
        return "bigint" if t != "HUGEINT" else "hugeint"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    if t in ("VARCHAR", "STRING"):
        return "string"
    return t.lower()


def compare(spark, con, run, sql, sf_dir):
    """(matches, message)"""
    df = run(spark, sf_dir)
    got_types = {n: kind(t) for n, t in df.dtypes}
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return True, f"rows={len(got[1])} (no SQL)"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want_types = {d[0]: kind(d[1]) for d in cur.description}
    want = normal(columns, cur.fetchall())
    if got[0] != want[0]:
        return False, f"columns {got[0]} != {want[0]}"
    odd = {c: (got_types[c], want_types[c]) for c in got[0] if got_types[c] != want_types[c]}
    if len(got[1]) != len(want[1]):
        return False, f"rows {len(got[1])} != {len(want[1])}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    if bad:
        return False, f"{len(bad)} of {len(got[1])} rows differ in {got[0]}, e.g. {bad[0][0]} != {bad[0][1]}"
    return not odd, f"rows={len(got[1])}" + (f" types {odd}" if odd else "")


def main(argv):
    from demandlab.catalog import all_queries, all_sql
    from demandlab.session import build_session

    sf = argv[0] if argv else "0.01"
    wanted = argv[1:]
    spark = build_session("oracle-check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"{DATA}/sf{sf}"
    con = connect(sf_dir)
    queries, sqls = all_queries(), all_sql()
    failed = 0
    for name, run in queries.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        started = time.monotonic()
        try:
            ok, message = compare(spark, con, run, sqls.get(name), sf_dir)
        except Exception as problem:
            ok, message = False, f"{type(problem).__name__}: {str(problem)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.monotonic() - started:.1f}s {message}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
