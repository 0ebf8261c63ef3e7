"""Compare registered queries with their DuckDB statements.

Run as ``python -m tests.parity [sf_dir] [query ...]`` for a report.
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"create view {table} as select * from '{path}'")
    return connection


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, str]:
    """Row count and a description of the first difference, empty if the results are equal."""
    names = sorted(df.columns)
    relation = connection.sql(sql)
    if sorted(relation.columns) != names:
        return -1, f"columns {names} != {sorted(relation.columns)}"
    started = time.time()
    mine = Counter(tuple(row[n] for n in names) for row in df.select(*names).collect())
    print(f"  [{time.time() - started:.1f}s in Spark]", end=" ")
    expected = Counter(relation.select(*[f'"{n}"' for n in names]).fetchall())
    only_mine, only_expected = mine - expected, expected - mine
    if only_mine or only_expected:
        key = lambda row: str(row)
        return sum(mine.values()), (
            f"{sum(only_mine.values())} rows differ\n  names    {names}\n"
            f"  got      {sorted(only_mine, key=key)[:2]}\n  expected {sorted(only_expected, key=key)[:2]}"
        )
    return sum(mine.values()), ""


def main(arguments: list[str]) -> int:
    import __spark_entry__ as contract

    sf_dir = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = local_session()
    connection = duck(sf_dir)
    wanted = arguments[1:] or list(contract.queries())
    statements = contract.oracle_sql()
    failed = 0
    for name in wanted:
        started = time.time()
        df = contract.queries()[name](spark, sf_dir)
        if name not in statements:
            print(f"{name:24s} no statement, {df.count()} rows, {time.time() - started:.1f}s", flush=True)
            continue
        count, problem = differences(df, connection, statements[name])
        failed += bool(problem)
        print(f"{name:24s} {count:8d} rows {time.time() - started:5.1f}s {problem or 'ok'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
