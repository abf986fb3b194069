"""Batch scoring: groups of rows through a scorer, retries, and one row out per row in.

A scorer is a picklable callable from a numpy matrix (rows x features) to two sequences that
run along the rows: the classes and the probability lists.  Transport trouble is signalled by
raising ``TimeoutError`` or ``ConnectionError``.
"""

from __future__ import annotations

import itertools
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import PREDICTION_SCHEMA, conform, traced
from tidemark.functions.messages import SHORT_REPLY, dead_letters
from tidemark.functions.scalars import features_json, prediction_text

# Rows per call, tries per call, base of the exponential wait in seconds.
BATCH_ROWS = 50
MAX_TRIES = 3
BACKOFF_BASE = 2

Reply = tuple[Sequence, Sequence]
Scorer = Callable[[np.ndarray], Reply]

_SCORED = [
    T.StructField("class_", T.LongType()),
    T.StructField("class_probabilities", T.ArrayType(T.DoubleType())),
    T.StructField("processing_time", T.DoubleType()),
    T.StructField("score_error", T.StringType()),
    T.StructField("score_message", T.StringType()),
    T.StructField("score_retries", T.LongType()),
    T.StructField("score_group", T.StringType()),  # the call that the row went into
]


class ThresholdRule:
    """Deterministic stand-in for a model: class by two thresholds on one feature."""

    def __init__(self, feature: int, low: float, high: float):
        self.feature, self.low, self.high = feature, low, high

    def __call__(self, matrix: np.ndarray) -> Reply:
        codes = np.digitize(matrix[:, self.feature], [self.low, self.high])
        return codes, (np.eye(3) * 0.7 + 0.1)[codes]


# What another try may mend, and the name under which it is reported.
TRANSIENT = {TimeoutError: "timeout", ConnectionError: "connection"}


def _label(problem: Exception) -> str:
    return next((name for kind, name in TRANSIENT.items() if isinstance(problem, kind)), "connection")


def _call(scorer: Scorer, matrix: np.ndarray, wait: Callable[[float], None]):
    """The reply, or the error that remained after all tries, plus the number of failed tries."""
    for failed in range(MAX_TRIES):
        if failed:
            wait(BACKOFF_BASE ** (failed - 1))
        try:
            return scorer(matrix), None, failed
        except tuple(TRANSIENT) as trouble:
            problem = trouble
        except Exception as trouble:  # a row's error, not the task's; another try mends nothing
            return ((), ()), trouble, failed
    return ((), ()), problem, MAX_TRIES


def score_rows(
    df: DataFrame,
    features: Sequence[str],
    scorer: Scorer,
    batch_rows: int = BATCH_ROWS,
    wait: Callable[[float], None] = time.sleep,
    group: str | None = None,
) -> DataFrame:
    """Adds class, probabilities, time per row, and the error of rows that got no reply.

    Rows keep their partition; each task feeds its Arrow batches to the scorer in groups of at
    most ``batch_rows``.  Rows that follow one another with the same ``group`` are called together
    and with no others.  Replies pair with rows by position, and a reply that is too short
    leaves an error on the rows it does not cover.
    """
    names = list(features)
    schema = T.StructType([*df.schema.fields, *_SCORED])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, calls = TaskContext.get().partitionId(), itertools.count()
        for batch in batches if group is None else _whole_groups(batches, group):
            # Only the features leave Arrow; every other column is handed through as it is.
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in names]
            matrix = np.column_stack(columns).astype(float)
            borders = [0, *([] if group is None else _changes(batch, group)), len(matrix)]
            parts = [
                _group(
                    scorer, matrix[start : min(start + batch_rows, end)], wait, f"{task}-{next(calls)}"
                )
                for begin, end in itertools.pairwise(borders)
                for start in range(begin, end, batch_rows)
            ]
            if not parts:
                continue
            scored = [pa.concat_arrays(column) for column in zip(*parts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *scored], [*batch.schema.names, *[f.name for f in _SCORED]]
            )

    return df.mapInArrow(score, schema)


def _changes(batch: pa.RecordBatch, group: str) -> list[int]:
    """Positions of the rows whose group is not that of the row before."""
    keys = batch.column(group).to_numpy(zero_copy_only=False)
    return (np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist()


def _whole_groups(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, cut where a group ends."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        whole = pa.concat_batches([*rest, batch])
        last = max(_changes(whole, group), default=0)
        if last:
            yield whole.slice(0, last)
        rest = [whole.slice(last)]
    yield from rest


def _group(
    scorer: Scorer, matrix: np.ndarray, wait: Callable[[float], None], name: str
) -> tuple[pa.Array, ...]:
    """The scored columns of one group of rows."""
    size = len(matrix)
    began = time.monotonic()
    (classes, chances), problem, retries = _call(scorer, matrix, wait)
    per_row = (time.monotonic() - began) / size
    answered = min(len(classes), size)
    unanswered = size - answered
    if problem is not None:
        error, text = _label(problem), str(problem)
    else:
        error, text = SHORT_REPLY, f"{len(classes)} replies for {size} rows"

    def column(values, filler, kind: pa.DataType) -> pa.Array:
        return pa.array([*values, *[filler] * unanswered], type=kind)

    none = [None] * answered
    return (
        column(classes[:answered], None, pa.int64()),
        column(chances[:answered], None, pa.list_(pa.float64())),
        column([per_row] * answered, None, pa.float64()),
        column(none, error, pa.string()),
        column(none, text, pa.string()),
        pa.array([retries] * size, type=pa.int64()),
        pa.array([name] * size, type=pa.string()),
    )


def group_sizes(scored: DataFrame) -> DataFrame:
    """The calls that the scorer got, as they happened, and the rows of each."""
    return scored.groupBy("score_group").agg(F.count("*").alias("rows"))


def predictions(
    scored: DataFrame,
    features: Sequence[str],
    service: str,
    as_of: Column,
    trace_id: Column | None = None,
) -> DataFrame:
    """Prediction rows of the rows that were scored; traced if there is an id."""
    return conform(
        scored.where(F.col("score_error").isNull()).select(
            "entity_id",
            features_json(features).alias("features"),
            F.coalesce(F.col("timestamp").try_cast("timestamp"), as_of).alias("timestamp"),
            prediction_text(F.col("class_")).alias("prediction"),
            F.coalesce("class_probabilities", F.array().cast("array<double>")).alias(
                "class_probabilities"
            ),
            as_of.alias("prediction_timestamp"),
            F.lit(service).alias("model_service"),
            "processing_time",
            as_of.alias("dataflow_processing_time"),
            *([] if trace_id is None else [trace_id.alias("trace_id")]),
        ),
        PREDICTION_SCHEMA if trace_id is None else traced(PREDICTION_SCHEMA),
    )


def score_failures(
    scored: DataFrame, as_of: Column, trace_id: Column | None = None
) -> DataFrame:
    """One dead letter per row that was not scored."""
    failed = scored.where(F.col("score_error").isNotNull()).withColumn(
        "error",
        F.struct(
            F.col("score_error").alias("error_type"),
            F.col("score_message").alias("error_message"),
        ),
    )
    return dead_letters(
        failed,
        "inference",
        "predict",
        as_of,
        entity_id=F.col("entity_id"),
        retry_count=F.col("score_retries"),
        trace_id=trace_id,
    )


def prediction_log(
    scored: DataFrame,
    features: Sequence[str],
    score: Column,
    threshold: float,
    model_version: str,
    as_of: Column,
) -> DataFrame:
    """Audit rows: score, decision, model version, threshold and the exact feature vector."""
    return scored.select(
        "transfer_id",
        "sender_id",
        as_of.alias("scored_at"),
        score.alias("fraud_score"),
        (score >= threshold).alias("is_fraud"),
        F.lit(model_version).alias("model_version"),
        F.lit(threshold).alias("threshold"),
        features_json(features).alias("features"),
    )
