"""Runs a query on Spark and its check SQL on DuckDB and compares the rows."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os
from collections import Counter

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


_SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def difference(df, connection, sql: str) -> str | None:
    """A description of the first difference, or None."""
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    types = dict(zip(names, [str(d[1]) for d in result.description]))
    expected_rows = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} expected {sorted(names)}"
    wrong = {
        n: (t, types[n])
        for n, t in df.dtypes
        if _SAME_TYPE.get(t, t).upper() != types[n].upper()
    }
    if wrong:
        return f"types differ: {wrong}"
    order = sorted(names)
    at = [names.index(n) for n in order]
    expected = Counter(tuple(_plain(r[i]) for i in at) for r in expected_rows)
    got = Counter(tuple(_plain(r[n]) for n in order) for r in df.collect())
    if expected != got:
        extra = list((got - expected).items())[:3]
        lacking = list((expected - got).items())[:3]
        return (
            f"{sum(got.values())} rows, expected {sum(expected.values())}\n"
            f"  columns {order}\n  only here {extra}\n  only there {lacking}"
        )
    return None
