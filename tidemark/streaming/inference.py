"""Inference stream: requests -> online features -> scores -> predictions and dead letters."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import DEAD_LETTER_SCHEMA, PREDICTION_SCHEMA, traced
from tidemark.functions.messages import (
    FETCH_ERROR,
    accepted,
    dead_letters,
    read_inference_messages,
    refused,
)
from tidemark.functions.scalars import truncated
from tidemark.operators.online import (
    MAX_LOOKUP_RETRIES,
    OnlineStore,
    enrich,
    missing_error,
)
from tidemark.operators.scoring import (
    BATCH_ROWS,
    Scorer,
    predictions,
    score_failures,
    score_rows,
)
from tidemark.operators.training import model_scores
from tidemark.sources.messages import each_once
from tidemark.sources.tables import create_table, scan_table, write_batch
from tidemark.streaming.features import start_batches
from tidemark.streaming.metrics import StageMetrics
from tidemark.streaming.retry import GROUP_REQUESTS, MISSED, RETRY_SECONDS, due_requests

_ASKED = ["trace_id", "entity_id", "timestamp", "retry_count"]


@dataclass
class InferenceStream:
    """Two queries: one serves the requests, one gives those without features their retries.

    A micro-batch is parsed, looked up, scored once and written as predictions and dead letters.
    Requests whose features are absent, or could not be read, go to a table that the second query
    streams into keyed state; when a request's timer fires it is looked up again, whether or not
    other messages follow, and after ``max_retries`` it becomes a dead letter.  Scores are written
    before they are split into predictions and failures, so the scorer is called once per row
    however often the batch is read.

    Micro-batches of the retries have numbers below zero in all tables, so that the two queries
    do not overwrite each other's.  A batch that is run again replaces its rows.
    """

    store: OnlineStore
    scorer: Scorer | PipelineModel
    service: str
    prediction_path: str
    work_path: str
    dead_letter_path: str | None = None
    metrics_path: str | None = None
    features: Sequence[str] = field(default_factory=list)
    batch_rows: int = BATCH_ROWS
    max_retries: int = MAX_LOOKUP_RETRIES
    retry_seconds: float = RETRY_SECONDS
    as_of: Column | None = None
    strict: bool = True

    def _now(self) -> Column:
        return F.current_timestamp() if self.as_of is None else self.as_of

    def process(self, messages: DataFrame, batch_id: int) -> None:
        """Serve one micro-batch of requests."""
        if "trace_id" not in messages.columns:
            messages = messages.withColumn("trace_id", F.lit(None).cast("string"))
        metrics = StageMetrics("inference")
        checked = read_inference_messages(messages)
        parsed = accepted(checked).select(
            "trace_id",
            "entity_id",
            "timestamp",
            F.lit(0).cast("bigint").alias("retry_count"),
        )
        letters = dead_letters(
            refused(checked),
            "inference",
            "parse",
            self._now(),
            payload=F.col("value"),
            trace_id=F.col("trace_id"),
        )
        checked.persist()
        try:
            with metrics.stage("parse"):
                wrong = F.count_if(F.col("error").isNotNull()).alias("error")
                right = F.count_if(F.col("error").isNull()).alias("success")
                metrics.add("parse", checked.agg(right, wrong).first().asDict())
            self._score(messages.sparkSession, parsed, letters, batch_id, metrics)
        finally:
            checked.unpersist()

    def retry(self, due: DataFrame, batch_id: int) -> None:
        """Look one micro-batch of due requests up again."""
        spark, number = due.sparkSession, -1 - batch_id
        # Written first: the timers' state is read and advanced once.
        path = f"{self.work_path}/due/batch_id={number}"
        due.write.mode("overwrite").parquet(path)
        due = spark.read.schema(MISSED).parquet(path)
        if due.isEmpty():
            return
        asked = due.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        none = spark.createDataFrame([], traced(DEAD_LETTER_SCHEMA))
        self._score(spark, asked.select(*_ASKED), none, number, StageMetrics("inference"))
        # Only now, with all sinks written, do these requests wait no more.
        due.select("group_id").distinct().write.mode("overwrite").parquet(
            f"{self.work_path}/settled/batch_id={number}"
        )

    def _looked_up(self, spark: SparkSession, asked: DataFrame, number: int) -> DataFrame:
        """The requests with their features, as written; ``fetch_error`` where reading failed.

        Only the look-up is tried; what the requests themselves come from is written before.
        """
        names = list(self.features)
        path = f"{self.work_path}/asked/batch_id={number}"
        asked.write.mode("overwrite").parquet(path)
        asked = spark.read.schema(asked.schema).parquet(path)
        nothing = spark.createDataFrame([], ", ".join(["entity_id string", *[f"{n} double" for n in names]]))
        staged = f"{self.work_path}/looked-up/batch_id={number}"
        fine = F.lit(None).cast("string")
        try:
            known = self.store.lookup(asked)
            found = enrich(asked, nothing if known is None else known, "entity_id", names)
            found = found.withColumn("fetch_error", fine)
            found.write.mode("overwrite").parquet(staged)
        except (PySparkException, Py4JJavaError) as problem:
            found = enrich(asked, nothing, "entity_id", names)
            found = found.withColumn("fetch_error", truncated(F.lit(str(problem))))
            found.write.mode("overwrite").parquet(staged)
        return spark.read.schema(found.schema).parquet(staged)

    def _score(
        self,
        spark: SparkSession,
        asked: DataFrame,
        parse_letters: DataFrame,
        number: int,
        metrics: StageMetrics,
    ) -> None:
        names, now = list(self.features), self._now()
        failed = F.col("fetch_error").isNotNull()
        again = failed | (F.size("missing") > 0)
        spent = F.col("retry_count") >= self.max_retries
        with metrics.stage("fetch"):
            found = self._looked_up(spark, asked, number)
            tally = found.agg(
                F.count_if(~again).alias("success"),
                F.count_if(again & ~failed & spent).alias("missing"),
                F.count_if(failed & spent).alias("error"),
                F.count_if(again & ~spent).alias("retry"),
            )
            fetched = tally.first().asDict()
            metrics.add("fetch", fetched)
        # Every group is whole in one file, so that its rows reach the timers together.
        groups = 1 + fetched["retry"] // GROUP_REQUESTS
        group = F.pmod(F.xxhash64("trace_id", "entity_id", "timestamp"), F.lit(groups))
        found.where(again & ~spent).groupBy(
            F.concat_ws("|", F.lit(str(number)), group).alias("group_id"),
            "trace_id",
            "entity_id",
            "timestamp",
            (F.col("retry_count") + 1).alias("retry_count"),
        ).agg(F.count("*").alias("copies")).repartition("group_id").write.mode(
            "overwrite"
        ).parquet(f"{self.work_path}/missed/batch {number}")
        fetch_error = F.struct(
            F.lit(FETCH_ERROR).alias("error_type"), F.col("fetch_error").alias("error_message")
        )
        lookup_letters = dead_letters(
            found.where(again & spent).withColumn(
                "error", F.when(failed, fetch_error).otherwise(missing_error())
            ),
            "inference",
            "fetch",
            now,
            entity_id=F.col("entity_id"),
            retry_count=F.col("retry_count"),
            trace_id=F.col("trace_id"),
        )

        with metrics.stage("score"):
            scores = f"{self.work_path}/scored/batch_id={number}"
            complete = found.where(~again).drop("missing", "fetch_error")
            if isinstance(self.scorer, PipelineModel):
                rated = model_scores(self.scorer, complete)
            else:
                rated = score_rows(complete, names, self.scorer, self.batch_rows)
            rated.write.mode("overwrite").parquet(scores)
            scored = spark.read.schema(rated.schema).parquet(scores)
            tally = scored.agg(
                F.count_if(F.col("score_error").isNull()).alias("success"),
                F.count_if(F.col("score_error").isNotNull()).alias("error"),
                F.count_if(F.col("score_retries") > 0).alias("retry"),
            )
            metrics.add("score", tally.first().asDict())
        with metrics.stage("write"):
            made = write_batch(
                predictions(scored, names, self.service, now, trace_id=F.col("trace_id")),
                self.prediction_path,
                number,
                traced(PREDICTION_SCHEMA),
                strict=self.strict,
                day_of="prediction_timestamp",
            )
            metrics.add("write", {"success": made.count()})
            if self.dead_letter_path is not None:
                letters = parse_letters.unionByName(lookup_letters).unionByName(
                    score_failures(scored, now, trace_id=F.col("trace_id"))
                )
                dead = write_batch(
                    letters, self.dead_letter_path, number, traced(DEAD_LETTER_SCHEMA)
                )
                metrics.add("write", {"error": dead.count()})
        if self.metrics_path is not None:
            metrics.write(spark, self.metrics_path, number, now)

    def start(self, messages: DataFrame, checkpoint: str, every: str | None = None):
        """The query that serves requests; a trace id that is delivered twice counts once."""
        return start_batches(each_once(messages), self.process, checkpoint, every)

    def start_retries(self, spark: SparkSession, checkpoint: str, every: str):
        """The query that runs the timers; it needs no messages to go on."""
        create_table(spark, f"{self.work_path}/missed/none", MISSED)
        missed = spark.readStream.schema(MISSED).parquet(f"{self.work_path}/missed/*")
        due = due_requests(missed, self.retry_seconds)
        return start_batches(due, self.retry, checkpoint, every)

    def lookups(self, spark: SparkSession) -> DataFrame:
        """The last look-up of every request: its features, and the error if it had none."""
        found = spark.read.parquet(f"{self.work_path}/looked-up").drop("batch_id")
        failed = F.when(F.col("fetch_error").isNotNull(), FETCH_ERROR)
        error = F.coalesce(failed, missing_error().getField("error_type"))
        last = error.isNull() | (F.col("retry_count") >= self.max_retries)
        return found.where(last).select(
            "trace_id", "entity_id", *self.features, "retry_count", error.alias("error_type")
        )

    def waiting(self, spark: SparkSession) -> int:
        """Requests, equal ones of a batch counted once, whose next look-up is still to come.

        Groups that are settled are known by name, one for some thousand requests.
        """
        missed = spark.read.schema(MISSED).parquet(f"{self.work_path}/missed/*")
        settled = scan_table(spark, f"{self.work_path}/settled", MISSED)
        if settled is not None:
            missed = missed.join(settled.select("group_id"), "group_id", "left_anti")
        return missed.count()

    def settle(self, spark: SparkSession, checkpoint: str, every: str = "200 milliseconds") -> None:
        """Run the timers until no request waits; for jobs that end."""
        run = self.start_retries(spark, checkpoint, every)
        try:
            while self.waiting(spark):
                if not run.isActive:
                    run.awaitTermination()  # raises what ended it
                    raise RuntimeError("the retries have stopped")
                time.sleep(0.2)
        finally:
            run.stop()
