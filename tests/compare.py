"""Run every query and its SQL counterpart on one folder and compare them.

    python -m tests.compare [folder] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
import traceback

import duckdb

NAMES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
         "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return repr(value)


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, fn, sql):
    """Message on the first difference, None when both sides agree."""
    df = fn(spark, folder)
    mine = [tuple(r) for r in df.collect()]
    if sql is None:
        return None if mine else "no rows", len(mine), None
    start = time.time()
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    took = time.time() - start
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}", len(mine), took
    odd = [(c, t, types[c]) for c, t in df.dtypes if NAMES.get(t, t) != types[c]]
    note = f"types differ {odd}" if odd else None
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}", len(mine), took
    a, b = _table(df.columns, mine), _table(names, theirs)
    for x, y in zip(a, b):
        if x != y:
            return f"{x} against {y}", len(mine), took
    return note, len(mine), took


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from kinmatch.session import build_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("compare", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(folder), oracle_sql(), 0
    for name, fn in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            message, n, took = compare(spark, con, folder, fn, oracles.get(name))
        except Exception as e:  # report and go on with the next query
            if wanted:
                traceback.print_exc()
            message, n, took = f"{type(e).__name__}: {str(e)[:300]}", -1, None
        bad += message is not None
        sql = "rows only" if name not in oracles else ("" if took is None else f"sql {took:.1f}s")
        print(f"{'ok ' if message is None else 'BAD'} {name} rows={n} {time.time() - start:.1f}s {sql} {message or ''}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()
