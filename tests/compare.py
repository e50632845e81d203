"""Runs every registered query next to its SQL check and reports differences.

    python -m tests.compare [folder] [query ...]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

DEFAULT = "/root/testdata/sf0.01"


def sql_session(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def norm(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, (int, str, datetime.datetime, datetime.date)):
        return value
    if isinstance(value, decimal.Decimal):
        raise TypeError("decimals must leave as doubles")
    raise TypeError(type(value))


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(norm(row[i]) for i in order) for row in rows]
    return sorted(names), sorted(out, key=repr)


def difference(spark, con, run, sql: str, folder: str) -> str | None:
    df = run(spark, folder)
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    theirs = canonical([c[0] for c in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows != {len(theirs[1])}"
    for a, b in zip(mine[1], theirs[1]):
        if repr(a) != repr(b):
            return f"first difference\n   {a}\n   {b}"
    return None


def main() -> None:
    import __spark_entry__ as entry
    from ridelake.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else DEFAULT
    only = sys.argv[2:]
    spark = local_session("compare")
    con = sql_session(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            found = difference(spark, con, run, oracle[name], folder) if name in oracle else "no SQL check"
        except Exception as error:  # noqa: BLE001
            found = f"{type(error).__name__}: {str(error)[:700]}"
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{bad} bad of {len(queries)}; checks without a query: {sorted(set(oracle) - set(queries))}")


if __name__ == "__main__":
    main()
