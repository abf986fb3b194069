"""Registry of the runnable queries and, where SQL can express them, their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query ``(spark, folder) -> DataFrame`` under its inventory name."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            configure(spark)
            return plain_timestamps(build(spark, folder.rstrip("/")))

        run.__name__ = name
        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            CHECKS[name] = sql
        return build

    return register


def plain_timestamps(df: DataFrame) -> DataFrame:
    """Timestamps as UTC wall-clock values, so results read the same under any session zone."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in zoned}) if zoned else df
