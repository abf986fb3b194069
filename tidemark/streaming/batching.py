"""Micro-batch sizing: rows of a scoring call, and the time limit after which a part is handed on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import equal_depth, running_totals

# Rows per scoring call, seconds before a flush.
SCORE_ROWS = 50
FLUSH_SECONDS = 1.0


def flush_trigger(seconds: float = FLUSH_SECONDS) -> str:
    """Processing-time trigger that hands on a partial group after the time limit."""
    return f"{int(seconds * 1000)} milliseconds"


def numbered(messages: DataFrame, number: str) -> DataFrame:
    """Adds ``rank``: the messages' places by ``number``, from 1; messages without one come last."""
    counted = messages.groupBy(*messages.columns).agg(F.count("*").alias("_n"))
    unknown = F.col(number).isNull()
    # Pieces of known numbers are below this one.
    piece = F.when(unknown, F.lit(2**40)).otherwise(F.col("_piece"))
    order = [unknown, F.col(number), *[F.col(c) for c in messages.columns if c != number]]
    placed = running_totals(
        equal_depth(counted, [], number), [], [piece], order, {"_upto": F.col("_n")}
    )
    ranks = F.sequence(F.col("_upto") - F.col("_n") + 1, F.col("_upto"))
    return placed.select(*messages.columns, F.explode(ranks).alias("rank"))
