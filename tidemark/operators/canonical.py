"""From raw tables to the canonical feature table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import IRIS, FeatureContract, keep_columns
from tidemark.functions.scalars import batch_entity_id, stream_entity_id
from tidemark.operators.ordered import running_totals
from tidemark.operators.splits import COPY_BLOCK, row_digest

STREAM_SOURCE = "streaming"  # fixed value


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the mapped columns the frame has; everything else passes through."""
    return df.withColumnsRenamed(dict(mapping))


def union_by_name(frames: Iterable[DataFrame | None]) -> DataFrame | None:
    """Rows of all frames, matched by column name; missing columns become null."""
    result = None
    for frame in frames:
        if frame is not None:
            result = (
                frame
                if result is None
                else result.unionByName(frame, allowMissingColumns=True)
            )
    return result


def default_timestamp(df: DataFrame, as_of: Column, source: str = "load_timestamp") -> Column:
    """The load time when the frame has that column (null rows stay null), else ``as_of``."""
    return F.col(source).cast("timestamp") if source in df.columns else as_of


def canonicalise(
    frames: Sequence[DataFrame | None], contract: FeatureContract, as_of: Column
) -> DataFrame | None:
    """Rename, union, derive timestamp and entity id, and trim to the contract."""
    camel = contract.renames("camel")
    combined = union_by_name(None if f is None else rename_columns(f, camel) for f in frames)
    if combined is None:
        return None
    derived = combined.withColumns(
        {
            contract.time: default_timestamp(combined, as_of),
            contract.entity: batch_entity_id(F.col("Id"), F.col("source")),
        }
    )
    return keep_columns(derived, contract.schema.fieldNames())


def feature_rows(
    messages: DataFrame, as_of: Column, contract: FeatureContract = IRIS
) -> DataFrame:
    """Validated stream messages as rows of the offline table."""
    snake = contract.renames("snake")
    return messages.select(
        *[F.col(source).alias(canonical) for source, canonical in snake.items()],
        F.lit(None).cast("string").alias(contract.label),
        F.lit(STREAM_SOURCE).alias("source"),
        stream_entity_id(F.col("sample_id")).alias(contract.entity),
        as_of.cast("timestamp").alias(contract.time),
        *[c for c in ("trace_id",) if c in messages.columns],
    )


def append_with_next_id(
    existing: DataFrame, new: DataFrame, id_column: str = "Id", seed: int = 0
) -> DataFrame:
    """Number ``new`` from the largest existing id + 1 (from 1 when there is none).

    Rows are numbered in seeded md5 order.  Digest prefixes cut the numbering into even chunks on
    two levels, 4096 parents of 4096 each; every chunk carries the rows before it.  Equal rows are
    counted together; a large group of copies gets its numbers block by block in several tasks.
    """
    columns = new.columns
    placed = new.withColumn("_digest", row_digest(columns, seed))
    distinct = placed.groupBy(*columns, "_digest").agg(F.count("*").alias("_m"))
    top = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("_top"))
    chunk = [F.substring("_digest", 1, 3), F.substring("_digest", 4, 3)]
    order = [F.col(c) for c in ("_digest", *columns)]
    first = running_totals(distinct, [], chunk, order, {"_upto": F.col("_m")}).withColumn(
        "_first", top.scalar() + F.col("_upto") - F.col("_m") + 1
    )
    last = F.col("_first") + F.col("_m") - 1
    few = first.where(F.col("_m") <= COPY_BLOCK).select(
        F.explode(F.sequence("_first", last)).alias(id_column), *columns
    )
    blocks = (
        first.where(F.col("_m") > COPY_BLOCK)
        .withColumn("_from", F.explode(F.sequence("_first", last, F.lit(COPY_BLOCK).cast("bigint"))))
        .repartition("_from")
    )
    upto = F.least(F.col("_from") + COPY_BLOCK - 1, last)
    many = blocks.select(F.explode(F.sequence("_from", upto)).alias(id_column), *columns)
    return few.unionByName(many)
