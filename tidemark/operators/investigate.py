"""Questions asked of the predictions, dead-letter and feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def run_sizes(predictions: DataFrame, runs: int = 10, since: Column | None = None) -> DataFrame:
    """Rows and distinct classes of the newest batch runs."""
    rows = predictions if since is None else predictions.where(F.col("prediction_timestamp") > since)
    return (
        rows.groupBy("prediction_timestamp")
        .agg(
            F.count("*").alias("row_count"),
            F.count_distinct("prediction").alias("distinct_classes"),
        )
        .orderBy(F.desc("prediction_timestamp"))
        .limit(runs)
    )


def prediction_distribution(predictions: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Predictions per hour and class over the last hours."""
    since = as_of - F.make_dt_interval(hours=F.lit(hours))
    return (
        predictions.where((F.col("prediction_timestamp") > since))
        .groupBy(F.date_trunc("HOUR", "prediction_timestamp").alias("hour"), "prediction")
        .agg(F.count("*").alias("predictions"))
        .orderBy("hour", "prediction")
    )


def latest_run(predictions: DataFrame) -> DataFrame:
    """Rows of the newest batch run."""
    newest = predictions.agg(F.max("prediction_timestamp")).scalar()
    return predictions.where(F.col("prediction_timestamp") == newest)


def dead_letter_rates(letters: DataFrame, as_of: Column, hours: int = 1) -> DataFrame:
    since = as_of - F.make_dt_interval(hours=F.lit(hours))
    return (
        letters.where(F.col("timestamp") > since)
        .groupBy("pipeline", "stage", "error_type")
        .agg(F.count("*").alias("dead_letters"))
    )


def entity_trace(predictions: DataFrame, entity_id: str, rows: int = 10) -> DataFrame:
    """Newest predictions of one entity."""
    return (
        predictions.where(F.col("entity_id") == entity_id)
        .orderBy(F.desc("prediction_timestamp"))
        .limit(rows)
    )


def slow_predictions(predictions: DataFrame, since: Column) -> DataFrame:
    """Recent predictions that needed a retry, slowest feature fetch first."""
    retried = (F.col("feature_fetch_retry_count") > 0) | (F.col("prediction_retry_count") > 0)
    return (
        predictions.where((F.col("prediction_timestamp") > since) & retried)
        .select(
            "entity_id",
            "trace_id",
            "feature_fetch_latency_ms",
            "feature_fetch_retry_count",
            "prediction_retry_count",
            "processing_time",
            F.get_json_object("features", "$.sepal_length_cm").alias("sepal_length"),
        )
        .orderBy(F.desc("feature_fetch_latency_ms"))
    )
