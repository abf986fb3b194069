"""Point-in-time join: for each spine row the feature values current at its time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.ordered import CHUNK_ROWS, equal_depth, last_before


def point_in_time_join(
    spine: DataFrame,
    features: DataFrame,
    entity: str,
    spine_time: str,
    feature_time: str,
    tie_break: Sequence[str] = (),
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Left as-of join: the newest feature row at or before each spine row's time.

    Both sides are merged into one time-ordered run per (entity, chunk) and the last feature
    row is carried forward; a small table with the last feature row of every earlier chunk
    fills the start of each chunk.  Chunks hold about as many rows each, wherever on the time
    axis an entity's rows crowd, so neither a hot entity nor a long history lands in one task.
    """
    values = [c for c in features.columns if c != entity]
    payload = F.struct(*[F.col(c) for c in values])
    empty = F.lit(None).cast(features.select(payload.alias("p")).schema["p"].dataType)
    spine_row = F.struct(*[F.col(c) for c in spine.columns if c != entity])
    no_spine = F.lit(None).cast(spine.select(spine_row.alias("p")).schema["p"].dataType)
    rank = F.struct(*[F.col(c) for c in tie_break]) if tie_break else F.struct(F.lit(0).alias("z"))
    no_rank = F.lit(None).cast(features.select(rank.alias("p")).schema["p"].dataType)

    facts = features.where(F.col(feature_time).isNotNull()).select(
        entity,
        F.col(feature_time).alias("_at"),
        F.lit(0).alias("_side"),
        rank.alias("_rank"),
        payload.alias("_fact"),
        no_spine.alias("_row"),
    )
    asked = spine.select(
        entity,
        F.col(spine_time).alias("_at"),
        F.lit(1).alias("_side"),
        no_rank.alias("_rank"),
        empty.alias("_fact"),
        spine_row.alias("_row"),
    )
    both = facts.unionByName(asked)
    both = both.withColumn("_micros", F.unix_micros(F.col("_at").cast("timestamp")))
    rows = equal_depth(both, [entity], "_micros", chunk_rows).drop("_micros")
    run = Window.partitionBy(entity, "_piece").orderBy("_at", "_side", "_rank")
    upto = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = rows.withColumn("_current", F.last("_fact", ignorenulls=True).over(upto)).where(
        F.col("_side") == 1
    )
    is_fact = F.col("_side") == 0
    # Of every chunk its last feature row; a chunk is carried past those that have none.
    last = rows.groupBy(entity, "_piece").agg(
        F.max_by(F.when(is_fact, F.col("_fact")), F.when(is_fact, F.struct("_at", "_rank"))).alias("_last")
    )
    carry = last_before(last, [entity], ["_piece"], {"_last": "_carried"}).select(
        F.col(entity).alias("_e"), F.col("_piece").alias("_c"), "_carried"
    )
    same = F.col(entity).eqNullSafe(F.col("_e")) & (F.col("_piece") == F.col("_c"))
    return (
        local.join(carry, same, "left")
        .withColumn("_found", F.coalesce("_current", "_carried"))
        .select(
            entity,
            *[F.col(f"_row.{c}").alias(c) for c in spine.columns if c != entity],
            *[F.col(f"_found.{c}").alias(c) for c in values],
        )
    )


def feature_age(
    predictions: DataFrame, features: DataFrame, since: Column, entity: str = "entity_id"
) -> DataFrame:
    """Seconds between writing a feature row and each recent prediction that used the entity."""
    recent = predictions.where(F.col("prediction_timestamp") > since)
    age = F.timestamp_diff(
        "SECOND",
        F.col("feature_timestamp").cast("timestamp"),
        F.col("prediction_timestamp").cast("timestamp"),
    )
    return (
        recent.select(entity, "prediction_timestamp")
        .join(features.select(entity, "feature_timestamp"), entity)
        .withColumn("feature_age_seconds", age)
        .orderBy(F.desc("feature_age_seconds"))
    )
