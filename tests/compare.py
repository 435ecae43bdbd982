"""Runs registered queries beside their SQL twins.

``python -m tests.compare [--sf DIR] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    if isinstance(value, int):
        return repr(float(value)) if abs(value) < 2**53 else repr(value)
    return str(value)


def normalized(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells)


def spark_result(df) -> tuple[list[str], list[tuple]]:
    return normalized(df.columns, [tuple(r) for r in df.collect()])


def sql_result(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = con.execute(sql)
    return normalized([d[0] for d in cursor.description], cursor.fetchall())


def difference(got: tuple[list[str], list[tuple]], want: tuple[list[str], list[tuple]]) -> str | None:
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows, expected {len(want[1])}"
    extra = sorted(set(got[1]) - set(want[1]))[:2]
    lacking = sorted(set(want[1]) - set(got[1]))[:2]
    if extra or lacking or got[1] != want[1]:
        count = sum(1 for a, b in zip(got[1], want[1]) if a != b)
        return f"{count} rows differ; only here {extra}; only there {lacking}"
    return None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as entry
    from tests.conftest import make_session

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--skip", nargs="*", default=[])
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = make_session()
    con = connect(args.sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        if name in args.skip:
            continue
        begin = time.time()
        try:
            got = spark_result(queries[name](spark, args.sf))
            problem = difference(got, sql_result(con, oracles[name])) if name in oracles else None
            rows = len(got[1])
        except Exception as error:  # report every query, then fail
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", 0
        label = "ok " if problem is None else "BAD"
        bad += problem is not None
        print(f"{label} {name} {rows} rows {time.time() - begin:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
