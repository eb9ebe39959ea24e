"""Run checks on Spark and on DuckDB and compare them row by row."""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

EXACT = False


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def simple(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else (value if EXACT else float(f"{value:.12g}"))
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(simple(row[i]) for i in order) for row in rows)


def compare(spark_df, connection, sql: str) -> str:
    """Empty text when both sides agree, else what differs."""
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    expected = rows_of(names, relation.fetchall())
    got_names = spark_df.columns
    if sorted(got_names) != sorted(names):
        return f"columns {sorted(got_names)} != {sorted(names)}"
    actual = rows_of(got_names, spark_df.collect())
    if actual == expected:
        return ""
    extra, missing = actual - expected, expected - actual
    return (
        f"rows {sum(actual.values())} vs {sum(expected.values())}; columns {sorted(names)}; "
        f"only spark {sum(extra.values())}: {list(extra)[:2]}; only sql {sum(missing.values())}: {list(missing)[:2]}"
    )


def main() -> int:
    from fiscoframe import checks
    from fiscoframe.session import local_session

    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--exact", action="store_true", help="compare floats bit by bit")
    args = parser.parse_args()
    global EXACT
    EXACT = args.exact
    queries, sql = checks.loaded(checks.QUERIES), checks.loaded(checks.SQL)
    names = [n for n in queries if not args.names or any(n.startswith(p) for p in args.names)]
    logging.disable(logging.CRITICAL)
    spark, connection = local_session(), connect(args.sf)
    spark.sparkContext.setLogLevel("OFF")
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = queries[name](spark, args.sf)
            if name in sql:
                problem = compare(df, connection, sql[name])
                kind = "equal" if not problem else "DIFFERENT"
            else:
                problem, kind = "", f"rows {df.count()}"
        except Exception as error:  # report and go on with the next one
            problem, kind = f"{type(error).__name__}: {str(error)[:300]}", "ERROR"
        failed += bool(problem)
        print(f"{name:40s} {kind:10s} {time.time() - start:6.2f}s {problem}", flush=True)
    print(f"{len(names)} checks, {failed} failed")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
