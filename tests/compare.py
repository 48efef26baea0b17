"""Side-by-side run of the queries and their SQL: python tests/compare.py [folder] [names…]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
from pyspark.sql import DataFrame, SparkSession

from tierweave.plans.oracle import ORACLE
from tierweave.plans.queries import QUERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(r) for r in df.select(*names).collect()), key=repr)


def duck_rows(connection: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    result = connection.execute(sql)
    given = [d[0] for d in result.description]
    names = sorted(given)
    order = [given.index(n) for n in names]
    return names, sorted((tuple(r[i] for i in order) for r in result.fetchall()), key=repr)


def differences(mine: tuple, theirs: tuple) -> str | None:
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} / {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows / {len(theirs[1])} rows"
    for a, b in zip(mine[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"\n  {dict(zip(mine[0], a))}\n  {dict(zip(mine[0], b))}"
    return None


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    bad = 0
    for name in wanted:
        started = time.time()
        try:
            mine = spark_rows(QUERIES[name](spark, folder))
            took = time.time() - started
            problem = differences(mine, duck_rows(connection, ORACLE[name])) if name in ORACLE else "no SQL"
        except Exception as e:
            mine, took, problem = ([], []), time.time() - started, f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name} {len(mine[1])} rows {took:.1f}s {problem or ''}", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} match")


if __name__ == "__main__":
    main()
