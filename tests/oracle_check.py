"""Compares registered queries with DuckDB, value by value, on one scale."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb

TABLES = "/root/testdata/sf0.01"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[int, list]:
    frame = query(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    answer = con.execute(sql)
    columns = [d[0] for d in answer.description]
    assert sorted(columns) == sorted(frame.columns), (name, columns, frame.columns)
    want = rows_of(columns, answer.fetchall())
    differing = [] if got == want else [x for x in zip(got, want) if x[0] != x[1]][:3] or [(len(got), len(want))]
    return len(want), differing


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from keyfold.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else TABLES
    wanted = sys.argv[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    con = duck(sf_dir)
    oracles = oracle_sql()
    for name, query in queries().items():
        if name not in oracles or wanted and name not in wanted:
            continue
        started = time.time()
        try:
            rows, differing = compare(spark, con, name, query, oracles[name], sf_dir)
            verdict = "ok" if not differing else f"DIFF {differing}"
        except Exception as error:  # noqa: BLE001 - report and go on
            rows, verdict = -1, f"ERROR {str(error)[:600]}"
        print(f"{name:28} {rows:8} {time.time() - started:6.2f}s {verdict}", flush=True)
