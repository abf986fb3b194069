"""Unbounded message sources: a frame with a binary ``value`` and a ``trace_id`` per message."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.tables import is_folder


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of a parquet table that grows by whole files (a folder, or one file)."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if is_folder(spark, path):
        return reader.parquet(path)
    folder, _, name = path.rpartition("/")
    return reader.option("pathGlobFilter", name).parquet(folder)


def broker_stream(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Stream of a Kafka topic; ``topic-partition-offset`` identifies each message."""
    source = spark.readStream.format("kafka").options(**options).load()
    return source.select(
        F.col("value"),
        F.concat_ws("-", "topic", "partition", "offset").alias("trace_id"),
    )


#: How long a message that is delivered again is still recognised.
REDELIVERED_WITHIN = "1 hour"


def each_once(messages: DataFrame, within: str = REDELIVERED_WITHIN) -> DataFrame:
    """A stream's messages, each trace id once; without ids, or with a null one, all of them.

    The state holds the ids that arrived within the last hour, partitioned by id.
    """
    if "trace_id" not in messages.columns:
        return messages
    known = F.coalesce("trace_id", F.uuid())
    return (
        messages.withColumns({"_arrived": F.current_timestamp(), "_once": known})
        .withWatermark("_arrived", within)
        .dropDuplicatesWithinWatermark(["_once"])
        .drop("_arrived", "_once")
    )


def with_trace_id(messages: DataFrame, *identity: str) -> DataFrame:
    """Keep the source's own message id as ``trace_id`` through every later stage."""
    return messages.withColumn("trace_id", F.concat_ws("-", *identity))
