"""Run registered queries next to their SQL twins: ``python -m parcelmood.checks.compare``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def local_session(cores: int = 8) -> SparkSession:
    from parcelmood.session import configure

    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("parcelmood")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(directory) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(repr(value + 0.0))
    return value


def sorted_rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def spark_rows(frame: DataFrame) -> tuple[list[str], list[tuple]]:
    names = frame.columns
    return sorted(names), sorted_rows(names, [tuple(r) for r in frame.collect()])


def sql_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    relation = connection.execute(sql)
    names = [d[0] for d in relation.description]
    return sorted(names), sorted_rows(names, relation.fetchall())


_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


def differences(frame: DataFrame, result, connection, sql: str) -> list[str]:
    """Empty when names, types, row counts and values agree."""
    names, rows = result
    sql_names, expected = sql_rows(connection, sql)
    found = []
    if names != sql_names:
        return [f"columns {names} != {sql_names}"]
    kinds = dict(connection.execute(f"SELECT column_name, column_type FROM (DESCRIBE {sql})").fetchall())
    for name, kind in frame.dtypes:
        if _KINDS.get(kind, kind) != kinds[name]:
            found.append(f"type of {name}: {kind} != {kinds[name]}")
    if len(rows) != len(expected):
        found.append(f"rows {len(rows)} != {len(expected)}")
    differing = [(a, b) for a, b in zip(rows, expected) if a != b]
    if differing:
        found.append(f"{len(differing)} rows differ in {names}, first {differing[0]}")
    return found


def main(arguments: list[str]) -> int:
    from parcelmood.checks import all_queries

    directory = arguments[0] if arguments else "/root/testdata/sf0.01"
    queries, oracles = all_queries()
    wanted = arguments[1:] or list(queries)
    spark, connection = local_session(), connect(directory)
    failures = 0
    for name in wanted:
        start, spent = time.time(), float("nan")
        try:
            frame = queries[name](spark, directory)
            rows = spark_rows(frame)
            spent = time.time() - start
            if name in oracles:
                problems = differences(frame, rows, connection, oracles[name])
                verdict = "; ".join(problems) if problems else "ok"
            else:
                problems, verdict = [], f"rows {len(rows[1])}"
        except Exception as error:  # report and go on with the next query
            problems = [verdict := f"{type(error).__name__}: {str(error)[:600]}"]
        failures += bool(problems)
        print(f"{spent:7.2f}s {name:28s} {verdict}", flush=True)
    print(f"{len(wanted) - failures} of {len(wanted)} fine")
    spark.stop()
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
