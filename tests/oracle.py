"""Side-by-side run of a query and its SQL; also a command: ``python tests/oracle.py FOLDER [NAME...]``."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(df, sql: str, connection) -> str | None:
    """None when columns and rows agree, else what differs."""
    cursor = connection.execute(sql)
    expected_columns, expected = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    columns, found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if found != expected:
        extra, missing = list((found - expected).items()), list((expected - found).items())
        return f"{len(extra)} rows only in Spark, {len(missing)} only in SQL\n  {columns}\n  {extra[:3]}\n  {missing[:3]}"
    if not expected:
        return "no rows"
    return None


def main(folder: str, names: list[str]) -> None:
    from docfields.catalog import all_queries
    from docfields.session import local_session

    spark, connection = local_session(), connect(folder)
    bad = 0
    for name, query in all_queries().items():
        if names and not any(name.startswith(n) for n in names):
            continue
        begun = time.time()
        try:
            if query.sql:
                result = compare(query.run(spark, folder), query.sql, connection)
            else:
                result = f"rows only: {len(query.run(spark, folder).collect())}"
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(result) and not str(result).startswith("rows only")
        print(f"{name:32} {time.time() - begun:6.1f}s {result or 'ok'}", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
