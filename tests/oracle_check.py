"""Compare registered queries with their SQL in DuckDB: columns, types, rows and values."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb

# Spark type -> DuckDB type.
TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (datetime.datetime, datetime.date, decimal.Decimal)):
        return str(value)
    return value


def differences(spark, con, fn, sql: str, sf_dir: str) -> list[str]:
    df = fn(spark, sf_dir)
    cursor = con.execute(sql)
    theirs_types = {d[0]: str(d[1]) for d in cursor.description}
    theirs = cursor.fetchall()
    columns = sorted(df.columns)
    if columns != sorted(theirs_types):
        return [f"columns {columns} != {sorted(theirs_types)}"]
    out = []
    for field in df.schema.fields:
        expected = TYPES.get(field.dataType.simpleString(), "?")
        if expected != theirs_types[field.name]:
            out.append(f"type of {field.name}: {field.dataType.simpleString()} != {theirs_types[field.name]}")
    order = [list(theirs_types).index(c) for c in columns]
    ours_rows = sorted((tuple(normal(row[c]) for c in columns) for row in df.collect()), key=repr)
    their_rows = sorted((tuple(normal(row[i]) for i in order) for row in theirs), key=repr)
    if len(ours_rows) != len(their_rows):
        out.append(f"rows {len(ours_rows)} != {len(their_rows)}")
    wrong = [(a, b) for a, b in zip(ours_rows, their_rows) if a != b]
    if wrong:
        out.append(f"{len(wrong)} rows differ {columns}, first {wrong[0]}")
    return out
