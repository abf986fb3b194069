"""The roles the test tables play: raw samples, messages, transfers, users, predictions, metrics.

Every role exists twice: as a DataFrame and as a SQL common table expression of the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import IRIS, FeatureContract
from tidemark.operators.canonical import canonicalise

AS_OF_TEXT = "2024-01-31 00:00:00"
SERVICE = "rule://threshold"
FEATURES = list(IRIS.features)


def as_of(text: str = AS_OF_TEXT) -> Column:
    """A fixed moment instead of the wall clock."""
    return F.lit(text).cast("timestamp")


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """A test table with its timestamps as UTC instants."""
    df = spark.read.parquet(f"{folder}/{table}.parquet")
    wall = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({n: F.col(n).cast("timestamp") for n in wall}) if wall else df


def with_ctes(body: str, *names: str) -> str:
    """``body`` preceded by the named expressions and everything they build on."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in _NEEDS.get(name, ()):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in ordered) + "\n" + body


# --- raw samples and the canonical feature table, from lineitem ---------------------------

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


def raw(spark: SparkSession, folder: str) -> DataFrame:
    training = F.col("l_linestatus") == "F"
    species = (
        F.when(F.col("l_returnflag") == "A", "Iris-setosa")
        .when(F.col("l_returnflag") == "N", "Iris-versicolor")
        .otherwise("Iris-virginica")
    )
    return load(spark, folder, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("Id"),
        F.col("l_quantity").alias("SepalLengthCm"),
        F.col("l_extendedprice").alias("SepalWidthCm"),
        F.col("l_discount").alias("PetalLengthCm"),
        F.col("l_tax").alias("PetalWidthCm"),
        F.when(training, species).alias("Species"),
        F.when(training, "training").otherwise("batch_input").alias("source"),
        F.col("l_shipdate").alias("load_timestamp"),
    )


def canonical(
    spark: SparkSession, folder: str, contract: FeatureContract = IRIS
) -> DataFrame:
    return canonicalise([raw(spark, folder)], contract, as_of())


FEATURE_ORDER = ["feature_timestamp", *FEATURES, "species"]

# --- messages, from events ----------------------------------------------------------------


def member(name: str = "props") -> Column:
    return F.get_json_object(name, "$.k")


def payload() -> Column:
    """JSON text of an event; its type decides whether and how the message is malformed."""
    head = F.concat(
        F.lit('{"sepal_length": '), F.col("value").cast("string"), F.lit(', "sepal_width": ')
    )
    tail = F.concat(
        F.lit(', "petal_length": 1.5, "petal_width": 0.2, "timestamp": "2026-01-01T00:00:00"'),
        F.lit(', "sample_id": '),
    )
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    return (
        F.when(kind == "purchase", F.concat(head, member(), tail, user, F.lit("}")))
        .when(
            kind == "click",
            F.concat(head, F.lit('" '), member(), F.lit('.5 "'), tail, user, F.lit(".0}")),
        )
        .when(
            kind == "view",
            F.concat(head, F.lit("true"), tail, F.lit('"'), user, F.lit('", "extra": [1]}')),
        )
        .when(kind == "signup", F.concat(head, F.lit("null"), tail, user, F.lit("}")))
        .otherwise(head)
    )


def request() -> Column:
    """JSON text of a scoring request for an event's user; error events carry none."""
    user = F.col("user_id").cast("string")
    kind = F.col("event_type")
    stamp = F.lit(', "timestamp": "2026-01-01T00:00:00"}')
    return (
        F.when(kind == "error", F.lit("{}"))
        .when(kind == "signup", F.concat(F.lit('{"sample_id": "'), user))
        .when(
            kind == "view",
            F.concat(F.lit('{"entity_id": "", "sample_id": '), user, stamp),
        )
        .otherwise(F.concat(F.lit('{"entity_id": "'), user, F.lit('_streaming"'), stamp))
    )


def as_messages(events: DataFrame, text: Column) -> DataFrame:
    return events.select(
        F.encode(text, "utf-8").alias("value"), F.col("event_id").cast("string").alias("trace_id")
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return as_messages(load(spark, folder, "events"), payload())


def requests(spark: SparkSession, folder: str) -> DataFrame:
    return as_messages(load(spark, folder, "events"), request())


# --- transfers and users, from events and customer ------------------------------------------


def as_transfers(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("transfer_id"),
        F.col("user_id").alias("sender_id"),
        member().alias("recipient_id"),
        F.lit("purchase").alias("source_currency"),
        F.col("event_type").alias("target_currency"),
        F.col("value").alias("source_amount"),
        F.col("ts").alias("created_at"),
        F.lit("training").alias("source"),
    )


def transfers(spark: SparkSession, folder: str) -> DataFrame:
    return as_transfers(load(spark, folder, "events"))


COUNTRY_OF_KEY = ("GB", "US", "DE", "AU", "SG", "BE", "FR", "CA")


def users(spark: SparkSession, folder: str) -> DataFrame:
    code = F.try_element_at(
        F.array(*[F.lit(c) for c in COUNTRY_OF_KEY]), F.col("c_nationkey") + 1
    )
    registered = F.date_add(
        F.lit("2023-10-01").cast("date"), (F.col("c_custkey") % 365).cast("int")
    )
    return load(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.coalesce(code, F.lit("ZZ")).alias("country_of_residence"),
        F.when(F.col("c_mktsegment") == "BUILDING", "Business")
        .otherwise("Personal")
        .alias("account_type"),
        F.when(F.col("c_acctbal") >= 0, "Verified").otherwise("Pending").alias("kyc_status"),
        registered.cast("timestamp").alias("registration_date"),
        F.when(F.col("c_custkey") % 7 == 0, 1).otherwise(0).alias("label"),
    )


# --- predictions and dead letters, from events ----------------------------------------------


def stream_predictions(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    features = F.to_json(F.struct(value.alias("sepal_length_cm"), member().alias("member")))
    return load(spark, folder, "events").select(
        F.concat(F.col("user_id").cast("string"), F.lit("_streaming")).alias("entity_id"),
        F.col("event_id").cast("string").alias("trace_id"),
        F.col("ts").alias("prediction_timestamp"),
        F.when(value < 20, "0").when(value < 60, "1").otherwise("2").alias("prediction"),
        features.alias("features"),
        (value / 1000).alias("processing_time"),
        value.alias("feature_fetch_latency_ms"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("feature_fetch_retry_count"),
        F.when(F.col("event_type") == "signup", 2).otherwise(0).alias("prediction_retry_count"),
    )


def run_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return stream_predictions(spark, folder).select(
        "entity_id",
        "prediction",
        F.date_trunc("DAY", "prediction_timestamp").alias("prediction_timestamp"),
    )


def letters(spark: SparkSession, folder: str) -> DataFrame:
    late = F.col("value") >= 40
    return (
        load(spark, folder, "events")
        .where("event_type = 'error'")
        .select(
            F.col("user_id").cast("string").alias("entity_id"),
            F.when(late, "inference").otherwise("feature").alias("pipeline"),
            F.when(late, "predict").otherwise("parse").alias("stage"),
            F.when(late, "timeout").otherwise("validation").alias("error_type"),
            F.concat(F.lit("value "), F.col("value").cast("string")).alias("error_message"),
            F.col("ts").alias("timestamp"),
        )
    )


# --- metrics and scored rows, from events ----------------------------------------------------

COUNTER_WRAP = 997  # counters start again after this many events


def gauges(spark: SparkSession, folder: str) -> DataFrame:
    """Latency-like samples with a job label."""
    return _samples(load(spark, folder, "events"), F.col("value"))


def counters(spark: SparkSession, folder: str) -> DataFrame:
    """Counters that grow with the event number and reset now and then."""
    return _samples(
        load(spark, folder, "events"), (F.col("event_id") % COUNTER_WRAP).cast("double")
    )


def _samples(events: DataFrame, value: Column) -> DataFrame:
    job = (F.col("user_id") % 3).cast("string")
    return events.select(
        "ts",
        F.col("event_type").alias("name"),
        F.create_map(F.lit("job"), job).alias("labels"),
        value.alias("value"),
    )


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Events with a score in 0..1 and a 0/1 label."""
    events = load(spark, folder, "events")
    top = events.agg(F.max("value")).scalar()
    return events.select(
        "event_id",
        (F.col("value") / top).alias("score"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("label"),
    )


_SPECIES = """CASE WHEN l_linestatus = 'F' THEN CASE l_returnflag
      WHEN 'A' THEN 'Iris-setosa' WHEN 'N' THEN 'Iris-versicolor' ELSE 'Iris-virginica' END END"""

_WINDOWS = ", ".join(
    f"{n} AS (PARTITION BY sender_id ORDER BY sec RANGE BETWEEN {s} PRECEDING AND CURRENT ROW)"
    for n, s in {"h1": 3600, "h24": 86400, "d7": 604800, "d30": 2592000}.items()
)

_NEEDS = {
    "features": ("raw",),
    "trained": ("features",),
    "latest": ("features",),
    "windows": ("transfers",),
    "transfer_features": ("windows", "users"),
    "recent": ("transfers",),
    "increases": ("counters",),
}

_CTES = {
    "raw": f"""
    SELECT l_orderkey * 10 + l_linenumber AS "Id", l_quantity AS "SepalLengthCm",
      l_extendedprice AS "SepalWidthCm", l_discount AS "PetalLengthCm", l_tax AS "PetalWidthCm",
      {_SPECIES} AS "Species",
      CASE l_linestatus WHEN 'F' THEN 'training' ELSE 'batch_input' END AS source,
      l_shipdate AS load_timestamp
    FROM lineitem""",
    "features": """
    SELECT "SepalLengthCm" AS sepal_length_cm, "SepalWidthCm" AS sepal_width_cm,
      "PetalLengthCm" AS petal_length_cm, "PetalWidthCm" AS petal_width_cm,
      "Species" AS species, source, concat(CAST("Id" AS VARCHAR), '_', source) AS entity_id,
      load_timestamp AS feature_timestamp
    FROM raw""",
    "trained": """
    SELECT *, CASE species WHEN 'Iris-versicolor' THEN 0 WHEN 'Iris-virginica' THEN 1
      WHEN 'Iris-setosa' THEN 2 END AS label
    FROM features WHERE source = 'training'""",
    "latest": """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY feature_timestamp DESC,
        sepal_length_cm DESC, sepal_width_cm DESC, petal_length_cm DESC, petal_width_cm DESC,
        species DESC NULLS LAST) AS rn
      FROM features) WHERE rn = 1""",
    "msgs": """
    SELECT CAST(event_id AS VARCHAR) AS trace_id, user_id, event_type, ts, value,
      json_extract_string(props, '$.k') AS k,
      '{"sepal_length": ' || CAST(value AS VARCHAR) || ', "sepal_width": ' AS head,
      ', "petal_length": 1.5, "petal_width": 0.2, "timestamp": "2026-01-01T00:00:00", '
        || '"sample_id": ' AS tail
    FROM events""",
    "transfers": """
    SELECT CAST(event_id AS VARCHAR) AS transfer_id, user_id AS sender_id,
      json_extract_string(props, '$.k') AS recipient_id, 'purchase' AS source_currency,
      event_type AS target_currency, value AS source_amount, ts AS created_at,
      'training' AS source, epoch_us(ts) // 1000000 AS sec,
      CASE WHEN event_type <> 'purchase' THEN 1 ELSE 0 END AS is_cross_border
    FROM events""",
    "users": """
    SELECT c_custkey AS user_id,
      CASE c_nationkey WHEN 0 THEN 0.2 WHEN 1 THEN 0.3 WHEN 2 THEN 0.2 WHEN 3 THEN 0.3
        WHEN 4 THEN 0.4 WHEN 5 THEN 0.2 WHEN 6 THEN 0.2 WHEN 7 THEN 0.3 ELSE 0.5 END::DOUBLE
        AS country_risk_score,
      CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS is_business,
      CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS is_kyc_verified,
      DATE '2023-10-01' + CAST(c_custkey % 365 AS INTEGER) AS registered,
      CASE WHEN c_custkey % 7 = 0 THEN 1 ELSE 0 END AS label
    FROM customer""",
    "windows": f"""
    SELECT *, count(*) OVER h1 AS tx_count_1h, count(*) OVER h24 AS tx_count_24h,
      count(*) OVER d7 AS tx_count_7d, count(*) OVER d30 AS tx_count_30d,
      avg(source_amount) OVER d7 AS avg_amount_7d, max(source_amount) OVER d7 AS max_amount_7d,
      sum(source_amount) OVER h24 AS total_amount_24h,
      CAST(sum(is_cross_border) OVER d7 AS DOUBLE) / count(*) OVER d7 AS cross_border_ratio_7d,
      len(list_distinct(list(recipient_id) OVER d7)) AS unique_recipients_7d,
      len(list_distinct(list(target_currency) OVER d7)) AS unique_currencies_7d
    FROM transfers WINDOW {_WINDOWS}""",
    "transfer_features": """
    SELECT concat(transfer_id, '_', source) AS entity_id, w.*, u.country_risk_score,
      u.is_business, u.is_kyc_verified, u.label,
      greatest(date_diff('day', u.registered, CAST(created_at AS DATE)), 0) AS account_age_days,
      CASE WHEN avg_amount_7d <> 0 THEN source_amount / avg_amount_7d END AS amount_ratio_to_avg
    FROM windows w JOIN users u ON w.sender_id = u.user_id""",
    "recent": """
    SELECT *, sec // 3600 AS hour, sec // 86400 AS day,
      epoch_us(TIMESTAMP '2024-01-31 00:00:00') // 1000000 AS now
    FROM transfers""",
    "preds": """
    SELECT concat(CAST(user_id AS VARCHAR), '_streaming') AS entity_id,
      CAST(event_id AS VARCHAR) AS trace_id, ts AS prediction_timestamp,
      CASE WHEN value < 20 THEN '0' WHEN value < 60 THEN '1' ELSE '2' END AS prediction,
      value, value / 1000 AS processing_time, value AS feature_fetch_latency_ms,
      CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS feature_fetch_retry_count,
      CASE WHEN event_type = 'signup' THEN 2 ELSE 0 END AS prediction_retry_count
    FROM events""",
    "letters": """
    SELECT CAST(user_id AS VARCHAR) AS entity_id,
      CASE WHEN value >= 40 THEN 'inference' ELSE 'feature' END AS pipeline,
      CASE WHEN value >= 40 THEN 'predict' ELSE 'parse' END AS stage,
      CASE WHEN value >= 40 THEN 'timeout' ELSE 'validation' END AS error_type,
      'value ' || CAST(value AS VARCHAR) AS error_message, ts AS "timestamp"
    FROM events WHERE event_type = 'error'""",
    "gauges": """
    SELECT ts, event_type AS name, CAST(user_id % 3 AS VARCHAR) AS job, value,
      epoch_us(ts) // 1000000 AS sec
    FROM events""",
    "counters": f"""
    SELECT ts, event_type AS name, CAST(user_id % 3 AS VARCHAR) AS job,
      CAST(event_id % {COUNTER_WRAP} AS DOUBLE) AS value, epoch_us(ts) // 1000000 AS sec
    FROM events""",
    "increases": """
    SELECT *, CASE WHEN before IS NULL THEN 0.0 WHEN value < before THEN value
      ELSE value - before END AS increase
    FROM (SELECT *, lag(value) OVER (PARTITION BY name, job ORDER BY ts, value) AS before
      FROM counters)""",
    "scored": """
    SELECT event_id, value / max(value) OVER () AS score,
      CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS label
    FROM events""",
}
