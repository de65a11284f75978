"""Run registered queries in Spark and DuckDB and compare the results."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracle import ORACLE_SQL
from checks.queries import QUERIES


def duckdb_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = connection.sql(sql)
    return result.columns, result.fetchall()


def _normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        (tuple((row[i] is None, row[i]) for i in order) for row in rows), key=repr
    )


def mismatch(spark: SparkSession, sf_dir: str, name: str) -> str | None:
    """None if both engines agree on column names, rows and values."""
    result = QUERIES[name](spark, sf_dir)
    ours = result.columns, [tuple(row) for row in result.collect()]
    theirs = duckdb_rows(sf_dir, ORACLE_SQL[name])
    if sorted(ours[0]) != sorted(theirs[0]):
        return f"columns {sorted(ours[0])} != {sorted(theirs[0])}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    left, right = _normal(*ours), _normal(*theirs)
    differing = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(differing)} rows differ, first: {differing[0]}" if differing else None


def main(sf_dir: str, *names: str) -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or QUERIES:
        started = time.perf_counter()
        try:
            problem = mismatch(spark, sf_dir, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:32} {time.perf_counter() - started:6.2f}s  {problem or 'ok'}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
