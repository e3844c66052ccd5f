"""Compare registered queries with their SQL: columns, row count and every value."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duckdb_tables(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", value.normalize() + 0)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return str(value)
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(spark, sf_dir: str, run, sql: str) -> tuple[str | None, int]:
    """None when equal, else what differs; and the number of rows."""
    frame = run(spark, sf_dir)
    ours = [tuple(row) for row in frame.collect()]
    cursor = duckdb_tables(sf_dir).execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} and {sorted(names)}", len(ours)
    wanted = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
    }
    for name, kind in frame.dtypes:
        expected = wanted.get(kind, kind.upper())
        if kinds[name].replace(" ", "") != expected:
            return f"type of {name}: {kind} and {kinds[name]}", len(ours)
    left, right = _bag(frame.columns, ours), _bag(names, theirs)
    if left != right:
        only_left, only_right = left - right, right - left
        return (
            f"{len(ours)} and {len(theirs)} rows; only ours {list(only_left)[:2]}, "
            f"only SQL {list(only_right)[:2]}"
        ), len(ours)
    return None, len(ours)


def main(names: list[str], sf_dir: str) -> int:
    from tallylake.checks import ORACLES, QUERIES
    from tallylake.session import build_session

    spark = build_session("compare", "local[8]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    failed = 0
    for name in names or list(QUERIES):
        start = time.time()
        try:
            if name in ORACLES:
                problem, rows = difference(spark, sf_dir, QUERIES[name], ORACLES[name])
            else:
                problem, rows = None, len(QUERIES[name](spark, sf_dir).collect())
        except Exception as error:  # noqa: BLE001
            problem, rows = f"{type(error).__name__}: {str(error)[:600]}", -1
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name:28s} {rows:7d} rows {time.time() - start:6.1f}s "
              f"{problem or ('' if name in ORACLES else '(rows only)')}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[2:], sys.argv[1]))
