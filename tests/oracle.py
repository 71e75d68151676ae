"""Compare registered queries with their SQL: ``python tests/oracle.py [--sf DIR] [name ...]``."""

from __future__ import annotations

import argparse
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, value)
    if isinstance(value, (int, float)):
        return (2, "nan") if isinstance(value, float) and math.isnan(value) else (2, repr(float(value)))
    return (3, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.sf)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        started = time.time()
        try:
            got = spark_rows(queries[name](spark, args.sf))
            took = time.time() - started
            if name not in oracle:
                print(f"rows {len(got[1]):7d} {took:6.2f}s {name}", flush=True)
                continue
            started = time.time()
            want = sql_rows(con, oracle[name])
            sql_took = time.time() - started
            same = got == want
            print(f"{'ok  ' if same else 'DIFF'} {len(got[1]):7d} {took:6.2f}s sql {sql_took:5.2f}s {name}", flush=True)
            if not same:
                bad += 1
                print("   columns", got[0], want[0], "rows", len(got[1]), len(want[1]))
                pairs = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
                print("   differing", len(pairs), pairs[:2])
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"FAIL {name}: {str(error)[-1500:]}", flush=True)
    print("bad", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
