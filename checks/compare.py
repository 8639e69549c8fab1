"""Run registered queries next to their SQL: ``python -m checks.compare [folder] [query ...]``"""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.oracles import ORACLES
from checks.queries import QUERIES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return repr(value)
    return str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda place: columns[place])
    return sorted(tuple(_plain(row[place]) for place in order) for row in rows)


def differences(spark: SparkSession, connection, folder: str, name: str) -> str | None:
    """None if the query and its SQL give the same rows, else what differs."""
    frame = QUERIES[name](spark, folder)
    columns, found = frame.columns, frame.collect()
    if name not in ORACLES:
        return None if found else "no rows"
    result = connection.execute(ORACLES[name])
    expected_columns = [entry[0] for entry in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(expected_columns):
        return f"columns {sorted(columns)} != {sorted(expected_columns)}"
    ours, theirs = _rows(columns, found), _rows(expected_columns, expected)
    if not ours:
        return "no rows"
    if ours != theirs:
        only_ours = [row for row in ours if row not in set(theirs)][:3]
        only_theirs = [row for row in theirs if row not in set(ours)][:3]
        return f"{len(ours)} rows, expected {len(theirs)}; {only_ours} / {only_theirs}"
    return None


def main() -> None:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(folder)
    failed = 0
    for name in names:
        started = time.time()
        try:
            problem = differences(spark, connection, folder, name)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:32s} {time.time() - started:6.1f}s {problem or 'ok'}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    sys.exit(failed > 0)


if __name__ == "__main__":
    main()
