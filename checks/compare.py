"""Run queries beside their SQL and compare rows: ``python -m checks.compare [sf_dir] [key ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES
from ledgermill.session import configure

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def local_session(cores: int = 8) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgermill")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "16g")
        # A test table is one row group and so one scan task: joining the larger ones by a shuffle spreads the work.
        .config("spark.sql.autoBroadcastJoinThreshold", "2mb")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, int):
        return float(f"{value:.15g}") if abs(value) < 2**53 else value
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty where the rows agree, else what differs."""
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns: spark only {set(df.columns) - set(names)}, sql only {set(names) - set(df.columns)}"
    expected, actual = _rows(names, found.fetchall()), _rows(df.columns, df.collect())
    if expected == actual:
        return ""
    more, less = actual - expected, expected - actual
    return (
        f"{sum(actual.values())} rows against {sum(expected.values())}; {sorted(names)}\n"
        f"  spark only {sum(more.values())}: {list(more)[:2]}\n  sql only {sum(less.values())}: {list(less)[:2]}"
    )


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(QUERIES)
    spark, con, wrong = local_session(), duck(sf_dir), 0
    for key in keys:
        began = time.time()
        try:
            df = QUERIES[key](spark, sf_dir)
            problem = differences(df, con, ORACLE_SQL[key]) if key in ORACLE_SQL else f"rows only: {df.count()}"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        wrong += bool(problem)
        print(f"{'DIFF' if problem else 'ok  '} {key} {time.time() - began:.2f}s {problem}", flush=True)
    print(f"{len(keys)} queries, {wrong} differ; without SQL: {sorted(set(QUERIES) - set(ORACLE_SQL))}")
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
