"""Feature stream: messages -> validated feature rows -> offline table and online store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.contract import DEAD_LETTER_SCHEMA, FEATURE_SCHEMA, traced
from tidemark.functions.messages import (
    BAD_JSON,
    INVALID,
    accepted,
    dead_letters,
    read_feature_messages,
    refused,
)
from tidemark.operators.canonical import STREAM_SOURCE, feature_rows
from tidemark.operators.online import OnlineStore
from tidemark.sources.messages import each_once
from tidemark.sources.tables import write_batch
from tidemark.streaming.metrics import StageMetrics

#: Micro-batches after which the online store's changes become a new base.
COMPACT_EVERY = 20


@dataclass
class FeatureStream:
    """Writes each micro-batch once to every sink; replaying a batch replaces its output."""

    offline_path: str
    store: OnlineStore
    dead_letter_path: str | None = None
    metrics_path: str | None = None
    compact_every: int | None = COMPACT_EVERY
    as_of: Column | None = None

    def process(self, messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        now = F.current_timestamp() if self.as_of is None else self.as_of
        if "trace_id" not in messages.columns:
            messages = messages.withColumn("trace_id", F.lit(None).cast("string"))
        metrics = StageMetrics("feature")
        counts = Observation(f"parsed-{batch_id}")
        kind = F.col("error.error_type")
        checked = read_feature_messages(messages).observe(
            counts,
            F.count_if(kind.isNull()).alias("success"),
            F.count_if(kind == INVALID).alias("missing"),
            F.count_if(kind == BAD_JSON).alias("error"),
        )
        checked.persist()
        try:
            with metrics.stage("parse"):
                checked.count()  # fills what the sinks read
                metrics.add("parse", counts.get)
            rows = feature_rows(accepted(checked), now)
            with metrics.stage("offline"):
                # The store takes the rows as written: ids drawn at random agree in both sinks.
                written = write_batch(
                    rows, self.offline_path, batch_id, traced(FEATURE_SCHEMA), source=STREAM_SOURCE
                )
                stored = written.count()
                metrics.add("offline", {"success": stored})
            with metrics.stage("online"):
                self.store.upsert(written, batch_id)
                if self.compact_every and batch_id and batch_id % self.compact_every == 0:
                    self.store.compact(batch_id)
                metrics.add("online", {"success": stored})
            if self.dead_letter_path is not None:
                with metrics.stage("dead_letters"):
                    letters = dead_letters(
                        refused(checked),
                        "feature",
                        "parse",
                        now,
                        payload=F.col("value"),
                        trace_id=F.col("trace_id"),
                    )
                    dead = write_batch(
                        letters, self.dead_letter_path, batch_id, traced(DEAD_LETTER_SCHEMA)
                    )
                    metrics.add("dead_letters", {"success": dead.count()})
        finally:
            checked.unpersist()
        if self.metrics_path is not None:
            metrics.write(spark, self.metrics_path, batch_id, now)

    def start(self, messages: DataFrame, checkpoint: str, every: str | None = None):
        """A trace id that is delivered twice counts once."""
        return start_batches(each_once(messages), self.process, checkpoint, every)


def start_batches(messages: DataFrame, process, checkpoint: str, every: str | None = None):
    """Start a stream of micro-batches: every so often, or once over what is available."""
    writer = messages.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()
