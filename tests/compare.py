"""Run registered queries and their SQL side by side: python tests/compare.py SF_DIR [name...]."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from stockcast.session import build_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events".split()


def canonical(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(x):
        if isinstance(x, float):
            return "nan" if math.isnan(x) else repr(x + 0.0)
        return str(x)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def duck(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def compare(spark, con, folder, name):
    """(equal, seconds, message) of one query; equal is None without SQL."""
    begin = time.time()
    df = entry.queries()[name](spark, folder)
    rows = df.collect()
    seconds = time.time() - begin
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None, seconds, f"{len(rows)} rows, no SQL"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return False, seconds, f"columns {sorted(df.columns)} != {sorted(names)}"
    got, ref = canonical(rows, df.columns), canonical(want, names)
    if got == ref:
        return True, seconds, f"{len(rows)} rows"
    diff = [(a, b) for a, b in zip(got, ref) if a != b][:3]
    return False, seconds, f"{len(got)} vs {len(ref)} rows, {sum(a != b for a, b in zip(got, ref))} differ; {sorted(df.columns)}; e.g. {diff}"


if __name__ == "__main__":
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions=8, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    for name in wanted or entry.queries():
        try:
            equal, seconds, message = compare(spark, con, folder, name)
        except Exception as exc:  # report and go on with the next query
            equal, seconds, message = False, 0.0, f"{type(exc).__name__}: {str(exc)[:1500]}"
        print({True: "ok  ", False: "BAD ", None: "rows"}[equal], f"{seconds:6.2f}s", name, "-", message, flush=True)
