"""The pipelines as jobs: ingest, sync, train, batch inference and the two streams.

Run one with ``python -m tidemark.jobs <job> --help`` or call the functions.
"""

from __future__ import annotations

import argparse
import inspect

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import (
    DEAD_LETTER_SCHEMA,
    PREDICTION_SCHEMA,
    contract,
)
from tidemark.functions.scalars import label_code_strict
from tidemark.operators import evaluate, online, splits, training
from tidemark.operators.canonical import canonicalise
from tidemark.session import configure
from tidemark.sources import messages, tables
from tidemark.streaming.batching import FLUSH_SECONDS, SCORE_ROWS, flush_trigger
from tidemark.streaming.features import COMPACT_EVERY, FeatureStream
from tidemark.streaming.inference import InferenceStream
from tidemark.streaming.progress import ProgressMetrics


def ingest(
    spark: SparkSession,
    raw: str,
    batch_input: str,
    features: str,
    project: str = "iris",
    full: bool = False,
) -> bool:
    """Raw labelled and unlabelled tables -> canonical table; False when both are absent."""
    found = [tables.scan_table(spark, path) for path in (raw, batch_input)]
    rows = canonicalise(found, contract(project), F.current_timestamp())
    if rows is None:
        return False
    tables.write_refresh(rows, features, full=full)
    return True


def _store(spark: SparkSession, path: str, project: str) -> online.OnlineStore:
    roles = contract(project)
    if not roles.served:
        raise ValueError(f"contract {project!r} is not served online")
    return online.OnlineStore(spark, path, roles.entity, roles.features)


def sync(
    spark: SparkSession, features: str, store: str, project: str = "iris"
) -> None:
    """Offline table -> online store."""
    offline = tables.read_batches(spark, features, contract(project).sink)
    _store(spark, store, project).sync(offline)


def train(
    spark: SparkSession,
    features: str,
    work: str,
    model: str,
    project: str = "iris",
    seed: int = splits.SPLIT_SEED,
    trees: int = 100,
) -> DataFrame:
    """Fit both tree models, keep the more accurate one, return all accuracies.

    Each trainer holds out a fifth of its own training part for the accuracy it reports; the
    choice is made on the outer test part.
    """
    roles = contract(project)
    names, label = list(roles.features), "_label"
    stored = tables.read_batches(spark, features, contract(project).sink)
    rows = tables.scan_source(stored, "training").select(
        *names, label_code_strict(F.col(roles.label)).cast("double").alias(label)
    )
    key = [*names, label]
    outer = f"{work}/split"
    splits.train_test_split(rows, key, seed=seed).write.mode("overwrite").partitionBy(
        "split"
    ).parquet(outer)
    inner = f"{work}/nested"
    splits.nested_split(spark.read.parquet(outer), key).write.mode("overwrite").partitionBy(
        "split"
    ).parquet(inner)
    parts = spark.read.parquet(inner)
    fit, holdout, test = (parts.where(F.col("split") == s) for s in ("fit", "holdout", "test"))
    fitted = {
        training.DECISION_TREE: training.fit_decision_tree(fit, names, label, seed),
        training.RANDOM_FOREST: training.fit_random_forest(fit, names, label, seed, trees),
    }
    accuracies = [
        (name, part, training.model_accuracy(m, frame, label).first().accuracy)
        for name, m in fitted.items()
        for part, frame in (("holdout", holdout), ("test", test))
    ]
    metrics = spark.createDataFrame(accuracies, "model string, split string, accuracy double")
    best = evaluate.choose_best(metrics.where("split = 'test'")).first().model
    training.save_model(fitted[best], model)
    return metrics.withColumn("chosen", F.col("model") == best)


def batch_inference(
    spark: SparkSession,
    features: str,
    model: str,
    predictions: str,
    project: str = "iris",
    as_of: Column | None = None,
) -> None:
    """Append predictions for the batch-input rows."""
    fitted = training.load_model(model)
    training.check_feature_names(fitted, contract(project).features)
    stored = tables.read_batches(spark, features, contract(project).sink)
    rows = tables.scan_source(stored, "batch_input")
    # One moment per run: all its rows carry the same prediction time.
    now = spark.sql("SELECT current_timestamp() AS t").first().t if as_of is None else None
    moment = F.lit(now) if as_of is None else as_of
    tables.write_append(training.batch_inference(fitted, rows, model, moment), predictions)


def _messages(spark: SparkSession, source: str, topic: str) -> DataFrame:
    """A Kafka topic (``source`` names the servers), or a folder of ``value`` files.

    A file's messages are known by its name and their place in it.
    """
    if topic:
        return messages.broker_stream(
            spark, {"kafka.bootstrap.servers": source, "subscribe": topic}
        )
    schema = "value binary"
    stream = messages.file_stream(spark, source, schema)
    place = [F.col("_metadata.file_name"), F.col("_metadata.row_index").cast("string")]
    return stream.withColumn("trace_id", F.concat_ws("-", *place))


def _listener(spark: SparkSession, progress: str) -> ProgressMetrics | None:
    return ProgressMetrics(spark, progress) if progress else None


def feature_stream(
    spark: SparkSession,
    source: str,
    features: str,
    store: str,
    checkpoint: str,
    topic: str = "",
    dead_letters: str = "",
    metrics: str = "",
    progress: str = "",
    project: str = "iris",
    compact_every: int = COMPACT_EVERY,
    available_now: bool = False,
    no_wait: bool = False,
):
    """Messages -> offline table and online store.  Every table has to exist.

    ``metrics`` takes what the stages of a micro-batch did, ``progress`` what Spark says of triggers.
    """
    listener = _listener(spark, progress)
    stream = FeatureStream(
        features,
        _store(spark, store, project),
        dead_letters or None,
        metrics or None,
        compact_every=compact_every or None,
    )
    every = None if available_now else flush_trigger(FLUSH_SECONDS)
    query = stream.start(_messages(spark, source, topic), checkpoint, every)
    if listener:
        listener.follow(query, "feature")
    if not no_wait:
        try:
            query.awaitTermination()
        finally:
            if listener:
                listener.close()
    return query


def inference_stream(
    spark: SparkSession,
    source: str,
    store: str,
    model: str,
    predictions: str,
    checkpoint: str,
    topic: str = "",
    dead_letters: str = "",
    metrics: str = "",
    progress: str = "",
    project: str = "iris",
    batch_size: int = SCORE_ROWS,
    max_batch_duration_secs: float = FLUSH_SECONDS,
    available_now: bool = False,
    no_wait: bool = False,
):
    """Requests -> features from the store -> scores -> predictions by day.

    Requests without features get their retries from a second query, which an endless job runs
    beside the first one, and a job over what is available after it, until none waits.
    """
    listener = _listener(spark, progress)
    stream = InferenceStream(
        store=_store(spark, store, project),
        scorer=training.load_model(model),
        service=model,
        prediction_path=predictions,
        work_path=f"{checkpoint}/work",
        dead_letter_path=dead_letters or None,
        metrics_path=metrics or None,
        features=list(contract(project).features),
        batch_rows=batch_size,
    )
    every = None if available_now else flush_trigger(max_batch_duration_secs)
    asked = _messages(spark, source, topic)
    served = stream.start(asked, f"{checkpoint}/marks", every)
    retry_marks = f"{checkpoint}/retry-marks"
    if listener:
        listener.follow(served, "inference")
    try:
        if every is not None:
            retries = stream.start_retries(spark, retry_marks, every)
            if listener:
                listener.follow(retries, "retries")
            if not no_wait:
                spark.streams.awaitAnyTermination()
        elif not no_wait:
            served.awaitTermination()
            stream.settle(spark, retry_marks)
    finally:
        if listener and not no_wait:
            listener.close()
    return served


def create_tables(
    spark: SparkSession,
    features: str = "",
    predictions: str = "",
    dead_letters: str = "",
    project: str = "iris",
) -> None:
    """Create the stream sinks that are named."""
    for path, schema in (
        (features, contract(project).sink),
        (predictions, PREDICTION_SCHEMA),
        (dead_letters, DEAD_LETTER_SCHEMA),
    ):
        if path:
            tables.create_table(spark, path, schema)


JOBS = (ingest, sync, train, batch_inference, feature_stream, inference_stream, create_tables)


def parser() -> argparse.ArgumentParser:
    """Every job takes its function's parameters as options."""
    root = argparse.ArgumentParser(description=__doc__)
    commands = root.add_subparsers(dest="job", required=True)
    for job in JOBS:
        command = commands.add_parser(job.__name__, help=job.__doc__.splitlines()[0])
        for name, p in list(inspect.signature(job).parameters.items())[1:]:
            if name == "as_of":
                continue
            if isinstance(p.default, bool):
                command.add_argument(f"--{name}", action="store_true")
            elif p.default is inspect.Parameter.empty:
                command.add_argument(f"--{name}", required=True)
            else:
                command.add_argument(f"--{name}", default=p.default, type=type(p.default))
    return root


def main(arguments: list[str] | None = None) -> None:
    options = vars(parser().parse_args(arguments))
    job = next(j for j in JOBS if j.__name__ == options.pop("job"))
    spark = configure(SparkSession.builder.appName(f"tidemark-{job.__name__}").getOrCreate())
    result = job(spark, **options)
    if isinstance(result, DataFrame):
        result.show(truncate=False)


if __name__ == "__main__":
    main()
