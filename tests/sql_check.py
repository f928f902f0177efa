"""Compare registered queries with their SQL on DuckDB.

    python tests/sql_check.py [--sf 0.01] [--plain] [name prefix ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def _plain(v):
    if isinstance(v, list):
        return tuple(_plain(x) for x in v)
    return v


def compare(spark, con, folder: str, name: str, run, sql: str | None) -> str:
    started = time.time()
    df = run(spark, folder)
    ours_cols, ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    took = time.time() - started
    if sql is None:
        return f"rows  {name}: {len(ours)} rows, {took:.1f}s" if ours else f"EMPTY {name}"
    cursor = con.execute(sql)
    cols, theirs = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if ours_cols != cols:
        return f"DIFF  {name}: columns {ours_cols} / {cols}"
    if len(ours) != len(theirs):
        return f"DIFF  {name}: {len(ours)} / {len(theirs)} rows"
    bad = [(a, b) for a, b in zip(ours, theirs) if repr(a) != repr(b)]
    if bad:
        return f"DIFF  {name}: {len(bad)} of {len(ours)} rows, e.g.\n   ours {str(bad[0][0])[:600]}\n   sql  {str(bad[0][1])[:600]}"
    return f"ok    {name}: {len(ours)} rows, {took:.1f}s" if ours else f"EMPTY {name}"


def main() -> None:
    from __spark_entry__ import oracle_sql, queries
    from lendgrid.session import local_session

    args = sys.argv[1:]
    sf = "0.01"
    if "--sf" in args:
        at = args.index("--sf")
        sf = args[at + 1]
        del args[at:at + 2]
    folder = f"/root/testdata/sf{sf}"
    if "--plain" in args:  # Spark's own defaults, as another driver may use them
        args.remove("--plain")
        spark = SparkSession.builder.master("local[8]").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    else:
        spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = connect(folder), oracle_sql()
    for name, run in queries().items():
        if args and not any(name.startswith(a) for a in args):
            continue
        try:
            print(compare(spark, con, folder, name, run, sql.get(name)), flush=True)
        except Exception as error:  # report and go on with the next query
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
