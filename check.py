"""Compare queries with their oracle SQL on the test tables.

    python check.py [sf] [name-prefix ...]
"""

from __future__ import annotations

import importlib
import math
import os
import sys
import time

import duckdb

from formflow.bindings import TEST_TABLES
from formflow.session import build_session

ROOT = os.environ.get("TESTDATA", "/root/testdata")


def _cell(value):
    """A value in a form that both engines agree on."""
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "~"
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, float):
        return repr(float(value))
    if hasattr(value, "isoformat"):
        text = value.isoformat().replace("T", " ")
        return text[:-9] if text.endswith(" 00:00:00") else text
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def oracle_connection(root: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TEST_TABLES:
        con.execute(f"create view {t} as select * from '{root}/{t}.parquet'")
    return con


def compare(spark, con, root, fn, sql):
    """None if both sides agree, else what differs."""
    df = fn(spark, root)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None, len(got[1])
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {set(got[0]) ^ set(want[0])}", len(got[1])
    if got[1] != want[1]:
        a, b = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
        return f"{len(got[1])} vs {len(want[1])} rows; {got[0]}\n   spark  {sorted(a)[:2]}\n   oracle {sorted(b)[:2]}", len(got[1])
    return None, len(got[1])


def main(argv):
    sf = argv[0] if argv else "sf0.001"
    wanted = argv[1:]
    root = f"{ROOT}/{sf}"
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    entry = importlib.import_module(os.environ.get("ENTRY", "__spark_entry__"))
    oracle = entry.oracle_sql()
    con = oracle_connection(root)
    bad = 0
    for name, fn in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            problem, n = compare(spark, con, root, fn, oracle.get(name))
        except Exception as e:  # noqa: BLE001
            problem, n = f"{type(e).__name__}: {str(e)[:700]}", -1
        mark = "FAIL" if problem else ("ok  " if name in oracle else "rows")
        bad += bool(problem)
        print(f"{mark} {name:34s} {n:7d} rows {time.time() - start:6.2f}s" + (f"\n   {problem}" if problem else ""), flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
