"""Message validation, error routing and lookups (V and J rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import DEAD_LETTER_SCHEMA, PREDICTION_SCHEMA
from tidemark.functions import messages as msg
from tidemark.functions.scalars import flag
from tidemark.operators import asof, online, rings, scoring, splits
from tidemark.operators.velocity import user_attributes
from tidemark.plans import bindings as b
from tidemark.plans.bindings import with_ctes
from tidemark.plans.registry import query
from tidemark.plans.tables import VALID_SQL, event_stream
from tidemark.session import new_folder
from tidemark.sources import tables
from tidemark.streaming.inference import InferenceStream


@query("validate_feature_msg", with_ctes(VALID_SQL, "msgs"))
def validate_feature_msg(spark: SparkSession, folder: str) -> DataFrame:
    return msg.accepted(msg.read_feature_messages(b.messages(spark, folder))).drop("value")


@query(
    "validate_inference_msg",
    with_ctes(
        "SELECT trace_id, CAST(user_id AS VARCHAR) || '_streaming' AS entity_id,"
        " '2026-01-01T00:00:00' AS \"timestamp\" FROM msgs"
        " WHERE event_type IN ('purchase', 'click', 'view')",
        "msgs",
    ),
)
def validate_inference_msg(spark: SparkSession, folder: str) -> DataFrame:
    return msg.accepted(msg.read_inference_messages(b.requests(spark, folder))).drop("value")


@query(
    "route_tagged",
    "SELECT CASE WHEN event_type IN ('signup', 'error') THEN 'dead_letters' ELSE 'main' END AS route,"
    " CAST(event_id AS VARCHAR) AS trace_id FROM events",
)
def route_tagged(spark: SparkSession, folder: str) -> DataFrame:
    """Both routes of one checked stream: disjoint, and together everything."""
    checked = msg.read_feature_messages(b.messages(spark, folder))
    good = msg.accepted(checked).select(F.lit("main").alias("route"), "trace_id")
    bad = msg.refused(checked).select(F.lit("dead_letters").alias("route"), "trace_id")
    return good.unionByName(bad)


def _known(before: str | None = None) -> str:
    where = "" if before is None else f"WHERE ts < TIMESTAMP '{before}'"
    return f"""SELECT entity_id, last_value, last_k FROM (
  SELECT user_id + 20 AS entity_id, value AS last_value, CAST(k AS DOUBLE) AS last_k,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
  FROM msgs {where}) WHERE rn = 1"""


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    """Feature rows of all events, under ids shifted by 20 so that some lookups miss."""
    return b.load(spark, folder, "events").select(
        (F.col("user_id") + 20).alias("entity_id"),
        F.col("value").alias("last_value"),
        b.member().cast("double").alias("last_k"),
        F.col("ts").cast("timestamp").alias("feature_timestamp"),
    )


def user_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """Latest event per user."""
    return online.latest_per_entity(
        user_events(spark, folder), "entity_id", ["feature_timestamp"]
    )


NAMES = ["last_value", "last_k"]


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    return b.load(spark, folder, "events").select(
        F.col("event_id"), F.col("user_id").alias("entity_id")
    )


@query(
    "error_taxonomy",
    with_ctes(
        "SELECT * FROM (SELECT 'parse' AS stage, CASE event_type WHEN 'signup' THEN 'validation'"
        " WHEN 'error' THEN 'json_decode' ELSE 'none' END AS error_type FROM msgs"
        " UNION ALL SELECT 'request', CASE event_type WHEN 'signup' THEN 'json_decode'"
        " WHEN 'error' THEN 'missing_field' ELSE 'none' END FROM msgs"
        f" UNION ALL SELECT 'fetch', CASE WHEN s.entity_id IS NULL THEN 'missing_features'"
        f" ELSE 'none' END FROM msgs m LEFT JOIN ({_known()}) s"
        " ON m.user_id = s.entity_id"
        " UNION ALL SELECT 'fetch', 'fetch_error' FROM msgs"
        " WHERE event_type IN ('purchase', 'click', 'view')"
        " UNION ALL SELECT 'predict', 'timeout' FROM msgs"
        " UNION ALL SELECT 'predict', 'connection' FROM msgs)",
        "msgs",
    ),
)
def error_taxonomy(spark: SparkSession, folder: str) -> DataFrame:
    """The error type every stage assigns to each message."""
    kind = F.coalesce(F.col("error.error_type"), F.lit("none")).alias("error_type")
    parse = msg.read_feature_messages(b.messages(spark, folder)).select(
        F.lit("parse").alias("stage"), kind
    )
    asked = msg.read_inference_messages(b.requests(spark, folder)).select(
        F.lit("request").alias("stage"), kind
    )
    looked = online.enrich(
        _requests(spark, folder), user_snapshot(spark, folder), "entity_id", NAMES
    )
    fetch = looked.withColumn("error", online.missing_error()).select(
        F.lit("fetch").alias("stage"), kind
    )
    result = parse.unionByName(asked).unionByName(fetch).unionByName(_unreadable(spark, folder))
    for scorer in (_slow, _down):
        tried = scoring.score_rows(
            b.load(spark, folder, "events").select("event_id", "value"),
            ["value"],
            scorer,
            wait=_no_wait,
        )
        result = result.unionByName(
            tried.select(F.lit("predict").alias("stage"), F.col("score_error").alias("error_type"))
        )
    return result


def _unreadable(spark: SparkSession, folder: str) -> DataFrame:
    """What becomes of requests when the store cannot be read: the stream goes on."""
    store = online.new_store(spark, "entity_id", NAMES)
    broken = spark.createDataFrame([("not parquet",)], "value string")
    broken.write.text(f"{store.path}/_change={0:012d}")
    stream = _inference(spark, new_folder(spark, "unreadable"), store, max_retries=0)
    stream.process(b.requests(spark, folder), 0)
    letters = tables.read_batches(spark, stream.dead_letter_path, DEAD_LETTER_SCHEMA)
    return letters.where("stage = 'fetch'").select("stage", "error_type")


def _slow(matrix):
    raise TimeoutError("no reply in time")


def _down(matrix):
    raise ConnectionError("service unavailable")


def _no_wait(seconds: float) -> None:
    return None


@query(
    "merge_dead_letters",
    with_ctes(
        "SELECT stage, error_type, count(*) AS letters FROM ("
        " SELECT 'parse' AS stage, CASE event_type WHEN 'signup' THEN 'json_decode'"
        " ELSE 'missing_field' END AS error_type FROM msgs"
        " WHERE event_type IN ('signup', 'error')"
        f" UNION ALL SELECT 'fetch', 'missing_features' FROM msgs m LEFT JOIN"
        f" ({_known()}) s ON m.user_id = s.entity_id WHERE s.entity_id IS NULL"
        " UNION ALL SELECT 'predict', 'connection' FROM msgs) GROUP BY ALL",
        "msgs",
    ),
)
def merge_dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Parse, fetch and predict dead letters in one frame, counted."""
    failed = msg.refused(msg.read_inference_messages(b.requests(spark, folder)))
    parse = msg.dead_letters(failed, "inference", "parse", b.as_of(), payload=F.col("value"))
    looked = online.enrich(
        _requests(spark, folder), user_snapshot(spark, folder), "entity_id", NAMES
    )
    fetch = msg.dead_letters(
        looked.where(F.size("missing") > 0).withColumn("error", online.missing_error()),
        "inference",
        "fetch",
        b.as_of(),
        entity_id=F.col("entity_id").cast("string"),
    )
    tried = scoring.score_rows(
        b.load(spark, folder, "events").select(
            F.col("user_id").cast("string").alias("entity_id"), "value"
        ),
        ["value"],
        _down,
        wait=_no_wait,
    )
    predict = scoring.score_failures(tried, b.as_of())
    merged = parse.unionByName(fetch).unionByName(predict)
    return merged.groupBy("stage", "error_type").agg(F.count("*").alias("letters"))


@query(
    "missing_features",
    with_ctes(
        "SELECT trace_id, CASE event_type WHEN 'signup' THEN 'sepal_width'"
        " WHEN 'error' THEN 'petal_length,petal_width,sepal_length,sepal_width' ELSE '' END"
        " AS missing FROM msgs",
        "msgs",
    ),
)
def missing_features(spark: SparkSession, folder: str) -> DataFrame:
    checked = msg.read_feature_messages(b.messages(spark, folder))
    missing = F.array_join(msg.missing_features(msg.FEATURE_FIELDS), ",")
    return checked.select("trace_id", missing.alias("missing"))


# --- joins -------------------------------------------------------------------------------------


@query(
    "online_lookup",
    with_ctes(
        "SELECT m.trace_id, m.user_id AS entity_id, s.last_value, s.last_k,"
        " CASE WHEN s.entity_id IS NULL THEN 'last_k,last_value' ELSE '' END AS missing"
        f" FROM msgs m LEFT JOIN ({_known()}) s ON m.user_id = s.entity_id",
        "msgs",
    ),
)
def online_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Requests against the key-bucketed store: a base, and the latest events as a change."""
    store = online.new_store(spark, "entity_id", NAMES)
    store.sync(user_events(spark, folder).where(F.col("feature_timestamp") < b.as_of("2024-01-15")))
    store.upsert(user_snapshot(spark, folder), 0)
    asked = _requests(spark, folder)
    looked = online.enrich(asked, store.lookup(asked), "entity_id", NAMES)
    return looked.select(
        F.col("event_id").cast("string").alias("trace_id"),
        "entity_id",
        *NAMES,
        F.array_join("missing", ",").alias("missing"),
    )


@query(
    "lookup_retry",
    with_ctes(
        "SELECT m.trace_id, coalesce(a.last_value, z.last_value) AS last_value,"
        " CAST(CASE WHEN a.entity_id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS retry_count,"
        " CASE WHEN a.entity_id IS NULL AND z.entity_id IS NULL THEN 'missing_features' END"
        " AS error_type FROM msgs m"
        f" LEFT JOIN ({_known('2024-01-01 06:00:00')}) a"
        " ON m.user_id = a.entity_id"
        f" LEFT JOIN ({_known()}) z ON m.user_id = z.entity_id",
        "msgs",
    ),
)
def lookup_retry(spark: SparkSession, folder: str) -> DataFrame:
    """Requests of all events; what misses at first is tried again once its timer has fired."""
    base = new_folder(spark, "lookup-retry")
    store = online.new_store(spark, "entity_id", NAMES)
    known = user_events(spark, folder).withColumn("entity_id", F.col("entity_id").cast("string"))
    store.sync(known.where(F.col("feature_timestamp") < b.as_of("2024-01-01 06:00:00")))
    stream = _inference(spark, base, store)
    asked = F.concat(F.lit('{"entity_id": "'), F.col("user_id").cast("string"), F.lit('"}'))
    messages = b.as_messages(event_stream(spark, folder), asked)
    stream.start(messages, f"{base}/marks").awaitTermination()
    store.upsert(known, 0)  # features that come while requests wait
    stream.settle(spark, f"{base}/retry-marks")
    return stream.lookups(spark).select("trace_id", "last_value", "retry_count", "error_type")


def _inference(spark: SparkSession, base: str, store: online.OnlineStore, **how) -> InferenceStream:
    stream = InferenceStream(
        store=store,
        scorer=scoring.ThresholdRule(0, 20.0, 60.0),
        service=b.SERVICE,
        prediction_path=f"{base}/predictions",
        work_path=f"{base}/work",
        dead_letter_path=f"{base}/letters",
        features=NAMES,
        as_of=b.as_of(),
        **how,
    )
    tables.create_table(spark, stream.prediction_path, PREDICTION_SCHEMA)
    tables.create_table(spark, stream.dead_letter_path, DEAD_LETTER_SCHEMA)
    return stream


@query(
    "latest_per_entity",
    with_ctes(
        f"SELECT {', '.join(b.FEATURES)}, species, source, entity_id, feature_timestamp"
        " FROM latest",
        "latest",
    ),
)
def latest_per_entity(spark: SparkSession, folder: str) -> DataFrame:
    return online.latest_per_entity(b.canonical(spark, folder), "entity_id", b.FEATURE_ORDER)


@query(
    "point_in_time_join",
    """SELECT c.event_id, c.user_id, c.ts AS clicked_at, p.ts AS purchased_at,
      p.value AS last_purchase
    FROM (SELECT * FROM events WHERE event_type = 'click') c
    ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'purchase') p
      ON c.user_id = p.user_id AND c.ts >= p.ts""",
)
def point_in_time_join(spark: SparkSession, folder: str) -> DataFrame:
    events = b.load(spark, folder, "events")
    spine = events.where("event_type = 'click'").select(
        "event_id", "user_id", F.col("ts").alias("clicked_at")
    )
    facts = events.where("event_type = 'purchase'").select(
        "user_id", F.col("ts").alias("purchased_at"), F.col("value").alias("last_purchase")
    )
    return asof.point_in_time_join(
        spine, facts, "user_id", "clicked_at", "purchased_at", tie_break=["last_purchase"]
    )


@query(
    "feature_age",
    with_ctes(
        "SELECT p.entity_id, p.prediction_timestamp, f.feature_timestamp,"
        " (epoch_us(p.prediction_timestamp) - epoch_us(f.feature_timestamp)) // 1000000"
        " AS feature_age_seconds FROM preds p JOIN (SELECT entity_id,"
        " max(prediction_timestamp) AS feature_timestamp FROM preds"
        " WHERE prediction_timestamp <= TIMESTAMP '2024-01-30 12:00:00' GROUP BY entity_id) f"
        " ON p.entity_id = f.entity_id"
        " WHERE p.prediction_timestamp > TIMESTAMP '2024-01-30 12:00:00'",
        "preds",
    ),
)
def feature_age(spark: SparkSession, folder: str) -> DataFrame:
    made = b.stream_predictions(spark, folder)
    noon = b.as_of("2024-01-30 12:00:00")
    written = (
        made.where(F.col("prediction_timestamp") <= noon)
        .groupBy("entity_id")
        .agg(F.max("prediction_timestamp").alias("feature_timestamp"))
    )
    return asof.feature_age(made, written, noon)


@query(
    "transfer_user_join",
    with_ctes(
        "SELECT transfer_id, sender_id, source_amount, is_business, is_kyc_verified,"
        " country_risk_score, u.label FROM transfers t JOIN users u ON t.sender_id = u.user_id",
        "transfers",
        "users",
    ),
)
def transfer_user_join(spark: SparkSession, folder: str) -> DataFrame:
    people = user_attributes(b.users(spark, folder)).drop("registration_date")
    return (
        b.transfers(spark, folder)
        .select("transfer_id", "sender_id", "source_amount")
        .join(people, F.col("sender_id") == F.col("user_id"))
        .drop("user_id")
    )


CUTOFF_SQL = "(SELECT quantile_cont(epoch_us(o_orderdate), 0.8) FROM orders)"


@query(
    "exclude_boundary_users",
    f"""SELECT o_orderkey, o_custkey FROM orders WHERE epoch_us(o_orderdate) < {CUTOFF_SQL}
      AND o_custkey NOT IN (SELECT o_custkey FROM orders
        WHERE epoch_us(o_orderdate) >= {CUTOFF_SQL})""",
)
def exclude_boundary_users(spark: SparkSession, folder: str) -> DataFrame:
    """Rows before the cutoff of users without any row after it."""
    orders = b.load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    split = splits.time_user_split(orders, "o_custkey", "o_orderdate")
    return split.where("split <> 'test'").select("o_orderkey", "o_custkey")


@query(
    "cutoff_cross",
    f"""SELECT o_orderkey, CASE WHEN epoch_us(o_orderdate) >= {CUTOFF_SQL} THEN 1 ELSE 0 END
      AS after_cutoff FROM orders""",
)
def cutoff_cross(spark: SparkSession, folder: str) -> DataFrame:
    """Every row meets the one-row cutoff."""
    orders = b.load(spark, folder, "orders")
    late = F.unix_micros("o_orderdate") >= splits.cutoff(orders, "o_orderdate").scalar()
    return orders.select("o_orderkey", flag(late).alias("after_cutoff"))


_SLOT_SQL = """SELECT u.user_id, CAST(s.slot AS BIGINT) AS slot,
  coalesce(h.bucket, -1) AS bucket, coalesce(h.tx_count, 0) AS tx_count,
  round(coalesce(h.amount_sum, 0), 6) AS amount_sum, coalesce(h.amount_max, 0) AS amount_max,
  coalesce(h.cross_border_count, 0) AS cross_border_count
FROM (SELECT c_custkey AS user_id FROM customer) u
CROSS JOIN (SELECT unnest(range(24)) AS slot) s
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY user_id, bucket % 24
    ORDER BY bucket DESC) AS rn
  FROM (SELECT sender_id AS user_id, hour AS bucket, count(*) AS tx_count,
    sum(source_amount) AS amount_sum, max(source_amount) AS amount_max,
    CAST(sum(is_cross_border) AS BIGINT) AS cross_border_count
  FROM recent WHERE sec >= now - 86400 AND sec <= now GROUP BY ALL)) h
  ON h.user_id = u.user_id AND h.bucket % 24 = s.slot AND h.rn = 1"""


@query("slot_spine", with_ctes(_SLOT_SQL, "recent"))
def slot_spine(spark: SparkSession, folder: str) -> DataFrame:
    """Every user and hourly slot, empty slots with their default stamp."""
    bucketed = rings.buckets(b.transfers(spark, folder), rings.HOURLY, b.as_of())
    rows = rings.slot_rows(b.users(spark, folder), bucketed, rings.HOURLY)
    return rows.withColumn("amount_sum", F.round("amount_sum", 6))


class ShortReply:
    """Rule scorer that loses the last reply of every group."""

    def __init__(self, rule: scoring.ThresholdRule):
        self.rule = rule

    def __call__(self, matrix):
        classes, chances = self.rule(matrix)
        return classes[:-1], chances[:-1]


@query(
    "zip_predictions",
    with_ctes(
        "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS wrong, true AS answered FROM features",
        "features",
    ),
)
def zip_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Replies pair with rows by position; a row without a reply is reported, not dropped."""
    rows = b.canonical(spark, folder)
    scored = scoring.score_rows(rows, b.FEATURES, ShortReply(scoring.ThresholdRule(2, 0.03, 0.07)))
    petal = F.col("petal_length_cm")
    expected = F.when(petal < 0.03, 0).when(petal < 0.07, 1).otherwise(2)
    unanswered = F.col("class_").isNull() & (F.col("score_error") == msg.SHORT_REPLY)
    right = F.coalesce(F.col("class_") == expected, F.lit(False))
    return scored.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~(right | unanswered)).alias("wrong"),
        # One row of each group goes unanswered, and no more.
        (F.count_if(unanswered) <= 0.1 * F.count("*")).alias("answered"),
    )
