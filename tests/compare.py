"""Run registered queries beside their SQL twins and compare the rows.

``python -m tests.compare [folder] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        if os.path.exists(f"{folder}/{table}.parquet"):
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def _family(name: str) -> str:
    name = name.lower()
    for family, names in {
        "int32": ("int", "integer"), "int64": ("bigint", "long", "int64"), "string": ("string", "varchar"),
        "timestamp": ("timestamp", "timestamp_ntz"), "double": ("double", "float64"),
    }.items():
        if name in names:
            return family
    return name


def compare(connection, frame, sql: str) -> list[str]:
    """Differences between a DataFrame and a statement; empty when equal."""
    twin = connection.execute(sql)
    twin_columns = [d[0] for d in twin.description]
    twin_types = {d[0]: _family(str(d[1])) for d in twin.description}
    expected = _sorted_rows(twin_columns, twin.fetchall())
    actual = _sorted_rows(frame.columns, frame.collect())
    problems = []
    if sorted(frame.columns) != sorted(twin_columns):
        problems.append(f"columns {sorted(frame.columns)} != {sorted(twin_columns)}")
    spark_types = {n: _family(t) for n, t in frame.dtypes}
    typed = {n: (spark_types[n], twin_types[n]) for n in spark_types if n in twin_types
             and spark_types[n] != twin_types[n]}
    if typed:
        problems.append(f"types {typed}")
    if len(actual) != len(expected):
        problems.append(f"{len(actual)} rows != {len(expected)}")
    if actual != expected:
        extra, missing = set(actual) - set(expected), set(expected) - set(actual)
        problems.append(f"values: {len(extra)} rows differ: spark has {sorted(extra, key=repr)[:3]}, "
                        f"sql has {sorted(missing, key=repr)[:3]}")
    return problems


def main(arguments: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from txnrisk.session import build_session

    folder = arguments[0] if arguments else "/root/testdata/sf0.01"
    spark = build_session(master=f"local[{os.environ.get('TEST_CPUS', '8')}]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("FATAL")
    connection, statements, failed = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if arguments[1:] and name not in arguments[1:]:
            continue
        started = time.time()
        try:
            frame = run(spark, folder)
            if name in statements:
                problems = compare(connection, frame, statements[name])
                outcome = "equal" if not problems else "DIFFERS " + " | ".join(problems)
            else:
                problems, outcome = [], f"{len(frame.collect())} rows, no SQL twin"
        except Exception as error:  # report and go on with the next query
            problems, outcome = [error], f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problems)
        print(f"{name:34s} {time.time() - started:6.2f}s  {outcome}", flush=True)
    print(f"{failed} of {len(queries())} queries differ or fail")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
