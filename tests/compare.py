"""Run a query in Spark and its SQL in DuckDB, and compare all rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _key(row):
    return tuple((value is not None, str(type(value)), str(value)) for value in row)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def differences(df, con, sql) -> str | None:
    """None if both sides agree, else what differs first."""
    spark_columns, spark_rows = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    duck_columns, duck_rows = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if spark_columns != duck_columns:
        return f"columns {spark_columns} against {duck_columns}"
    if len(spark_rows) != len(duck_rows):
        return f"{len(spark_rows)} rows against {len(duck_rows)}: {spark_rows[:3]} against {duck_rows[:3]}"
    if not spark_rows:
        return "no rows on either side"
    for left, right in zip(spark_rows, duck_rows):
        if left != right or [type(v) for v in left] != [type(v) for v in right]:
            return f"{dict(zip(spark_columns, left))} against {dict(zip(duck_columns, right))}"
    return None
