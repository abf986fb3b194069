"""Streaming pipelines, run over everything available (R rows and the dual write)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import DEAD_LETTER_SCHEMA, FEATURE_SCHEMA, PREDICTION_SCHEMA, traced
from tidemark.operators import online, rings, scoring
from tidemark.plans import bindings as b
from tidemark.plans.bindings import with_ctes
from tidemark.plans.registry import query
from tidemark.plans.tables import VALID_SQL, event_stream
from tidemark.session import new_folder
from tidemark.sources import tables
from tidemark.streaming import rings as ring_stream
from tidemark.streaming.batching import FLUSH_SECONDS, SCORE_ROWS, flush_trigger, numbered
from tidemark.streaming.features import FeatureStream, start_batches
from tidemark.streaming.inference import InferenceStream
from tidemark.streaming.metrics import stage_counts


def run_feature_stream(spark: SparkSession, folder: str) -> FeatureStream:
    base = new_folder(spark, "feature-stream")
    stream = FeatureStream(
        offline_path=f"{base}/offline",
        store=online.OnlineStore(spark, f"{base}/online", "entity_id", b.FEATURES),
        dead_letter_path=f"{base}/letters",
        metrics_path=f"{base}/metrics",
        as_of=b.as_of(),
    )
    tables.create_table(spark, stream.offline_path, FEATURE_SCHEMA)
    tables.create_table(spark, stream.dead_letter_path, DEAD_LETTER_SCHEMA)
    messages = b.as_messages(event_stream(spark, folder), b.payload())
    stream.start(messages, f"{base}/marks").awaitTermination()
    return stream


_ID = "CASE WHEN sample_id = 0 THEN 'random' ELSE CAST(sample_id AS VARCHAR) || '_streaming' END"


def _known_id():
    drawn = F.col("entity_id").rlike("^[0-9a-f]{8}_streaming$") & ~F.col("entity_id").rlike(
        "^[0-9]+_streaming$"
    )
    return F.when(drawn, "random").otherwise(F.col("entity_id"))


@query(
    "feature_stream",
    with_ctes(
        "SELECT 'offline' AS sink, sepal_length AS sepal_length_cm, sepal_width AS sepal_width_cm,"
        f" CAST(NULL AS VARCHAR) AS error_type FROM ({VALID_SQL}) UNION ALL"
        " SELECT 'dead_letters', NULL, NULL, CASE event_type WHEN 'signup' THEN 'validation'"
        " ELSE 'json_decode' END FROM msgs WHERE event_type IN ('signup', 'error')",
        "msgs",
    ),
)
def feature_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Everything the stream wrote to the offline table and the dead-letter table."""
    stream = run_feature_stream(spark, folder)
    offline = tables.read_batches(spark, stream.offline_path, FEATURE_SCHEMA).select(
        F.lit("offline").alias("sink"),
        "sepal_length_cm",
        "sepal_width_cm",
        F.lit(None).cast("string").alias("error_type"),
    )
    letters = tables.read_batches(spark, stream.dead_letter_path, DEAD_LETTER_SCHEMA).select(
        F.lit("dead_letters").alias("sink"),
        F.lit(None).cast("double").alias("sepal_length_cm"),
        F.lit(None).cast("double").alias("sepal_width_cm"),
        "error_type",
    )
    return offline.unionByName(letters)


@query(
    "dual_write",
    with_ctes(
        f"""SELECT sink, count(DISTINCT entity) AS entities FROM (
          SELECT unnest(['offline', 'online']) AS sink, sample_id AS entity
          FROM ({VALID_SQL}) WHERE sample_id <> 0
          UNION ALL SELECT unnest(['offline', 'online']), -row_number() OVER ()
          FROM ({VALID_SQL}) WHERE sample_id = 0) GROUP BY sink""",
        "msgs",
    ),
)
def dual_write(spark: SparkSession, folder: str) -> DataFrame:
    """Entities per sink after the stream wrote both."""
    stream = run_feature_stream(spark, folder)
    offline = tables.read_batches(spark, stream.offline_path, FEATURE_SCHEMA)
    both = offline.select(F.lit("offline").alias("sink"), "entity_id").unionByName(
        stream.store.snapshot().select(F.lit("online").alias("sink"), "entity_id")
    )
    return both.groupBy("sink").agg(F.count_distinct("entity_id").alias("entities"))


def run_inference_stream(spark: SparkSession, folder: str) -> InferenceStream:
    """Requests of all events against a store that knows all buyers."""
    base = new_folder(spark, "inference-stream")
    store = online.OnlineStore(spark, f"{base}/online", "entity_id", ["last_value", "last_k"])
    events = b.load(spark, folder, "events")
    bought = events.where("event_type = 'purchase'")
    store.sync(
        bought.select(
            F.concat(F.col("user_id").cast("string"), F.lit("_streaming")).alias("entity_id"),
            F.col("value").alias("last_value"),
            b.member().cast("double").alias("last_k"),
            F.col("ts").alias("feature_timestamp"),
        )
    )
    stream = InferenceStream(
        store=store,
        scorer=scoring.ThresholdRule(0, 20.0, 60.0),
        service=b.SERVICE,
        prediction_path=f"{base}/predictions",
        work_path=f"{base}/work",
        dead_letter_path=f"{base}/letters",
        metrics_path=f"{base}/metrics",
        features=["last_value", "last_k"],
        as_of=b.as_of(),
    )
    tables.create_table(spark, stream.prediction_path, PREDICTION_SCHEMA)
    tables.create_table(spark, stream.dead_letter_path, DEAD_LETTER_SCHEMA)
    messages = b.as_messages(event_stream(spark, folder), b.request())
    stream.start(messages, f"{base}/marks").awaitTermination()
    stream.settle(spark, f"{base}/retry-marks")
    return stream


_OUTCOMES = """SELECT 'prediction' AS kind, trace_id, CAST(m.user_id AS VARCHAR) || '_streaming' AS entity_id,
    CASE WHEN s.v < 20 THEN '0' WHEN s.v < 60 THEN '1' ELSE '2' END AS outcome,
    CAST(NULL AS BIGINT) AS retry_count
  FROM msgs m JOIN (SELECT user_id, arg_max(value, ts) AS v FROM msgs
    WHERE event_type = 'purchase' GROUP BY 1) s
    ON m.user_id = s.user_id WHERE event_type IN ('purchase', 'click', 'view')
  UNION ALL SELECT 'dead_letter', trace_id, CAST(m.user_id AS VARCHAR) || '_streaming',
    'missing_features', 1
  FROM msgs m WHERE event_type IN ('purchase', 'click', 'view') AND user_id NOT IN (
    SELECT user_id FROM msgs WHERE event_type = 'purchase')
  UNION ALL SELECT 'dead_letter', trace_id, NULL, CASE event_type WHEN 'signup' THEN 'json_decode'
    ELSE 'missing_field' END, NULL FROM msgs WHERE event_type IN ('signup', 'error')"""


@query("inference_stream", with_ctes(_OUTCOMES, "msgs"))
def inference_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Requests of all events against a store that knows all buyers: what became of each."""
    stream = run_inference_stream(spark, folder)
    made = tables.read_batches(spark, stream.prediction_path, traced(PREDICTION_SCHEMA)).select(
        F.lit("prediction").alias("kind"),
        "trace_id",
        "entity_id",
        F.col("prediction").alias("outcome"),
        F.lit(None).cast("bigint").alias("retry_count"),
    )
    letters = tables.read_batches(spark, stream.dead_letter_path, traced(DEAD_LETTER_SCHEMA)).select(
        F.lit("dead_letter").alias("kind"),
        "trace_id",
        "entity_id",
        F.col("error_type").alias("outcome"),
        "retry_count",
    )
    return made.unionByName(letters)


@query(
    "micro_batch_size",
    f"""SELECT "limit", (rn - 1) // "limit" AS batch, count(*) AS "rows", min(event_id) AS first_id,
      max(event_id) AS last_id
    FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) AS rn FROM events),
      (SELECT unnest([{SCORE_ROWS}, 7]) AS "limit") GROUP BY 1, 2""",
)
def micro_batch_size(spark: SparkSession, folder: str) -> DataFrame:
    """Every group of consecutive events as the scorer got it, for two limits."""
    path = new_folder(spark, "numbered")
    events = b.load(spark, folder, "events").select("event_id", "value")
    numbered(events, "event_id").write.parquet(path)
    result = None
    for limit in (SCORE_ROWS, 7):
        batch = F.floor((F.col("rank") - 1) / limit)
        rows = spark.read.parquet(path).withColumn("batch", batch)
        scored = scoring.score_rows(
            rows.repartition("batch").sortWithinPartitions("batch", "rank"),
            ["value"],
            scoring.ThresholdRule(0, 20.0, 60.0),
            batch_rows=limit,
            group="batch",
        )
        found = scored.groupBy("score_group").agg(
            F.lit(limit).alias("limit"),
            F.min("batch").alias("batch"),
            F.count("*").alias("rows"),
            F.min("event_id").alias("first_id"),
            F.max("event_id").alias("last_id"),
        ).drop("score_group")
        result = found if result is None else result.unionByName(found)
    return result


@query("micro_batch_flush", "SELECT event_id, event_type FROM events")
def micro_batch_flush(spark: SparkSession, folder: str) -> DataFrame:
    """A partial group is handed on once the time limit has passed."""
    path, marks = new_folder(spark, "flushed"), new_folder(spark, "marks")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    events = event_stream(spark, folder).select("event_id", "event_type")
    run = start_batches(events, write, marks, every=flush_trigger(FLUSH_SECONDS))
    run.processAllAvailable()
    run.stop()
    return spark.read.parquet(path).select("event_id", "event_type")


_CLOSED = """hour * 3600 + 3600 <= (SELECT max(epoch_us(ts)) / 1000000 FROM events)"""
_HOURLY = f"""SELECT sender_id AS user_id, sec // 3600 AS bucket, count(*) AS tx_count,
  round(sum(source_amount), 6) AS amount_sum, max(source_amount) AS amount_max,
  CAST(sum(is_cross_border) AS BIGINT) AS cross_border_count
FROM recent WHERE {_CLOSED} GROUP BY 1, 2"""


def streamed_hours(spark: SparkSession, folder: str) -> DataFrame:
    path, marks = new_folder(spark, "hours"), new_folder(spark, "marks")
    stream = b.as_transfers(event_stream(spark, folder))
    run = (
        ring_stream.hourly_tumbling(stream, "0 seconds")
        .writeStream.format("parquet")
        .option("checkpointLocation", marks)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(path)
    )
    run.awaitTermination()
    return spark.read.parquet(path)


@query("hourly_tumbling", with_ctes(_HOURLY, "recent"))
def hourly_tumbling(spark: SparkSession, folder: str) -> DataFrame:
    """Closed clock hours per sender, as the stream emitted them."""
    return streamed_hours(spark, folder).withColumn("amount_sum", F.round("amount_sum", 6))


_STREAM_RING = f"""SELECT user_id, bucket % 24 AS slot, bucket, tx_count, amount_sum, amount_max,
  cross_border_count, recipients
FROM (SELECT *, row_number() OVER (PARTITION BY user_id, bucket % 24 ORDER BY bucket DESC) AS rn
  FROM (SELECT sender_id AS user_id, sec // 3600 AS bucket, count(*) AS tx_count,
    round(sum(source_amount), 6) AS amount_sum, max(source_amount) AS amount_max,
    CAST(sum(is_cross_border) AS BIGINT) AS cross_border_count,
    array_to_string(list_sort(list(DISTINCT recipient_id)), ',') AS recipients
  FROM recent WHERE {_CLOSED} GROUP BY 1, 2)) WHERE rn = 1"""


@query("ring_state", with_ctes(_STREAM_RING, "recent"))
def ring_state(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly rings kept as keyed state, as last emitted per user."""
    path, marks = new_folder(spark, "rings"), new_folder(spark, "marks")
    closed = ring_stream.closed_buckets(b.as_transfers(event_stream(spark, folder)), "0 seconds")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    run = (
        ring_stream.ring_state(closed, rings.HOURLY)
        .writeStream.foreachBatch(write)
        .outputMode("append")
        .option("checkpointLocation", marks)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
    emitted = spark.read.parquet(path)
    return ring_stream.latest_rings(emitted).withColumns(
        {"recipients": F.array_join("recipients", ","), "amount_sum": F.round("amount_sum", 6)}
    )


def _slots(rows: str, shift: str, closed: str) -> str:
    """The newest bucket of every slot; ``shift`` is what each amount is off by."""
    return f"""SELECT user_id, bucket % 24 AS slot, bucket, tx_count, amount_sum FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, bucket % 24 ORDER BY bucket DESC) AS rn
      FROM (SELECT sender_id AS user_id, hour AS bucket, count(*) AS tx_count,
        round(sum(source_amount + {shift}), 6) AS amount_sum FROM ({rows}) WHERE {closed}
        GROUP BY 1, 2)) WHERE rn = 1"""


_DISTORTED = """SELECT * FROM recent WHERE sender_id % 10 <> 2 UNION ALL
  SELECT * REPLACE (sender_id + 1000000 AS sender_id) FROM recent WHERE sender_id % 10 = 3"""
_CLOSED_TO_IT = """hour * 3600 + 3600 <= (
  SELECT max(epoch_us(ts)) / 1000000 FROM events WHERE user_id % 10 <> 2)"""


def distorted(transfers: DataFrame) -> DataFrame:
    """Some senders' amounts are wrong, some senders are lost, some come under two ids as well."""
    sender, kind = F.col("sender_id"), F.col("sender_id") % 10
    senders = F.when(kind == 2, F.array().cast("array<bigint>")).when(
        kind == 3, F.array(sender, sender + 1_000_000)
    )
    return transfers.withColumns(
        {
            "source_amount": F.col("source_amount") + F.when(kind == 1, 1.0).otherwise(0.0),
            "sender_id": F.explode(senders.otherwise(F.array(sender))),
        }
    )


@query(
    "reconcile",
    with_ctes(
        f"""SELECT 'before' AS phase, coalesce(s.user_id, t.user_id) AS user_id,
          coalesce(s.slot, t.slot) AS slot, CASE WHEN s.user_id IS NULL THEN 'missing'
            WHEN t.user_id IS NULL THEN 'extra' ELSE 'different' END AS status
        FROM ({_slots(_DISTORTED, "if(sender_id % 10 = 1, 1.0, 0.0)", _CLOSED_TO_IT)}) s
        FULL JOIN ({_slots("SELECT * FROM recent", "0.0", "true")}) t
          ON s.user_id = t.user_id AND s.slot = t.slot
        WHERE s.user_id IS NULL OR t.user_id IS NULL OR s.bucket <> t.bucket
          OR s.tx_count <> t.tx_count OR s.amount_sum <> t.amount_sum
        UNION ALL SELECT 'after', NULL, NULL, 'none'""",
        "recent",
    ),
)
def reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """Live rings of a distorted stream against the batch, and again after the repair.

    The second run streams the right transfers, from rings that the batch has computed.
    """
    base = new_folder(spark, "reconcile")
    live = ring_stream.RingStream(rings.HOURLY, f"{base}/rings", f"{base}/marks")
    stream = b.as_transfers(event_stream(spark, folder))
    live.start(distorted(stream), "0 seconds").awaitTermination()
    truth = rings.newest_slots(
        rings.buckets(b.transfers(spark, folder), rings.HOURLY), rings.HOURLY
    )
    found = new_folder(spark, "differences")
    live.differences(spark, truth).write.parquet(found)
    live.repair(spark, truth)
    live.start(stream, "0 seconds").awaitTermination()
    before = spark.read.parquet(found).select(
        F.lit("before").alias("phase"), "user_id", "slot", "status"
    )
    left = live.differences(spark, truth).agg(F.count("*").alias("n"))
    after = left.select(
        F.lit("after").alias("phase"),
        F.lit(None).cast("bigint").alias("user_id"),
        F.lit(None).cast("bigint").alias("slot"),
        F.when(F.col("n") == 0, "none").otherwise("some").alias("status"),
    )
    return before.unionByName(after)


def _sum(job: str, stage: str, name: str, where: str) -> str:
    count = f"CAST(count(*) FILTER (WHERE {where}) AS DOUBLE)"
    return f"SELECT '{job}' AS job, '{stage}' AS stage, '{name}' AS name, {count} AS total FROM known"


_VALID = "event_type IN ('purchase', 'click', 'view')"
_LATE = f"{_VALID} AND NOT buyer"
_METRICS = " UNION ALL ".join(
    [
        _sum("feature", "parse", "success", _VALID),
        _sum("feature", "parse", "missing", "event_type = 'signup'"),
        _sum("feature", "parse", "error", "event_type = 'error'"),
        _sum("feature", "offline", "success", _VALID),
        _sum("feature", "online", "success", _VALID),
        _sum("feature", "dead_letters", "success", f"NOT {_VALID}"),
        _sum("inference", "parse", "success", _VALID),
        _sum("inference", "parse", "error", f"NOT {_VALID}"),
        _sum("inference", "fetch", "success", f"{_VALID} AND buyer"),
        _sum("inference", "fetch", "missing", _LATE),
        _sum("inference", "fetch", "error", "false"),
        _sum("inference", "fetch", "retry", _LATE),
        _sum("inference", "score", "success", f"{_VALID} AND buyer"),
        _sum("inference", "score", "error", "false"),
        _sum("inference", "score", "retry", "false"),
        _sum("inference", "write", "success", f"{_VALID} AND buyer"),
        _sum("inference", "write", "error", f"NOT {_VALID} OR NOT buyer"),
    ]
)


@query(
    "stream_metrics",
    f"""WITH known AS (SELECT event_type, user_id IN (
      SELECT user_id FROM events WHERE event_type = 'purchase') AS buyer FROM events)
    {_METRICS}""",
)
def stream_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of all stages of both streams, from one metrics table each."""
    paths = [run(spark, folder).metrics_path for run in (run_feature_stream, run_inference_stream)]
    return stage_counts(spark.read.parquet(paths[0]).unionByName(spark.read.parquet(paths[1])))
