"""Compare registered queries with their SQL on DuckDB: names, types, rows, values."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if value is not None and type(value).__module__ == "decimal":
        return float(value)
    return value


def _sort_key(row):
    return tuple((v is not None, str(v)) for v in row)


def compare(spark, con, name, run, sql, folder) -> str | None:
    """None when equal, else what differs."""
    df = run(spark, folder)
    columns = sorted(df.columns)
    left = [tuple(_plain(r[c]) for c in columns) for r in df.collect()]
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != columns:
        return f"columns {columns} != {sorted(names)}"
    order = [names.index(c) for c in columns]
    right = [tuple(_plain(r[i]) for i in order) for r in result.fetchall()]
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    if not left:
        return "no rows"
    for a, b in zip(sorted(left, key=_sort_key), sorted(right, key=_sort_key)):
        for c, x, y in zip(columns, a, b):
            if x != y or type(x) is not type(y):
                return f"{c}: {x!r} ({type(x).__name__}) != {y!r} ({type(y).__name__}) in {str(a)[:300]} vs {str(b)[:300]}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from shelfwise import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8)
    con = connect(folder)
    sqls = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, run, sqls[name], folder) if name in sqls else f"rows {run(spark, folder).count()}"
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:24s} {time.time() - start:6.2f}s {'ok' if problem is None else problem}", flush=True)
    print("bad:", bad)
