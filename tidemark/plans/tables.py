"""Sources, sinks, projections and scalar functions (S, K, P rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import (
    DEAD_LETTER_SCHEMA,
    FEATURE_SCHEMA,
    IRIS,
    RAW_SCHEMA,
    conform,
    contract,
    keep_columns,
)
from tidemark.functions import messages as msg
from tidemark.functions import scalars as sc
from tidemark.operators import evaluate, online, scoring, splits
from tidemark.operators.canonical import (
    STREAM_SOURCE,
    canonicalise,
    default_timestamp,
    feature_rows,
    rename_columns,
    union_by_name,
)
from tidemark.operators.velocity import user_attributes
from tidemark.plans import bindings as b
from tidemark.plans.bindings import with_ctes
from tidemark.plans.registry import query
from tidemark.session import new_folder
from tidemark.sources import messages as streams
from tidemark.sources import tables
from tidemark.streaming.features import start_batches

_RAW = """SELECT "Id", "SepalLengthCm", "SepalWidthCm", "PetalLengthCm", "PetalWidthCm",
  "Species", source, load_timestamp FROM raw"""
_FEATURE_LIST = ", ".join(b.FEATURES)


@query("scan_table", with_ctes(_RAW, "raw"))
def scan_table(spark: SparkSession, folder: str) -> DataFrame:
    """Full scan; a table that does not exist is skipped."""
    missing = tables.scan_table(spark, f"{folder}/no_such_table.parquet")
    return union_by_name([missing, b.raw(spark, folder)])


@query(
    "scan_csv",
    with_ctes(
        'SELECT "Id", "SepalLengthCm", "SepalWidthCm", "PetalLengthCm", "PetalWidthCm", "Species"'
        " FROM raw",
        "raw",
    ),
)
def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "csv")
    names = [f.name for f in RAW_SCHEMA.fields if f.name not in ("source", "load_timestamp")]
    b.raw(spark, folder).select(*names).write.csv(path, header=True)
    schema = type(RAW_SCHEMA)([RAW_SCHEMA[n] for n in names])
    return tables.scan_csv(spark, path, schema)


@query(
    "scan_paged_concat",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem",
)
def scan_paged_concat(spark: SparkSession, folder: str) -> DataFrame:
    """File splits are the pages; the scan concatenates them."""
    return b.load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"
    )


def _stored_features(spark: SparkSession, folder: str) -> str:
    path = new_folder(spark, "features")
    tables.write_refresh(b.canonical(spark, folder), path)
    return path


@query(
    "scan_source_filter",
    with_ctes(f"SELECT entity_id, {_FEATURE_LIST}, species, source FROM features", "features"),
)
def scan_source_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Both source labels, each read as one partition of the stored table."""
    stored = spark.read.parquet(_stored_features(spark, folder))
    wanted = ["entity_id", *b.FEATURES, "species", "source"]
    return (
        tables.scan_source(stored, "training")
        .unionByName(tables.scan_source(stored, "batch_input"))
        .select(*wanted)
    )


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return streams.file_stream(spark, f"{folder}/events.parquet", b.EVENT_SCHEMA)


@query(
    "stream_source",
    with_ctes(
        "SELECT trace_id, CASE event_type WHEN 'purchase' THEN head || k || tail || who || '}'"
        " WHEN 'click' THEN head || '\" ' || k || '.5 \"' || tail || who || '.0}'"
        " WHEN 'view' THEN head || 'true' || tail || '\"' || who || '\", \"extra\": [1]}'"
        " WHEN 'signup' THEN head || 'null' || tail || who || '}' ELSE head END AS payload"
        " FROM (SELECT *, CAST(user_id AS VARCHAR) AS who FROM msgs)",
        "msgs",
    ),
)
def stream_source(spark: SparkSession, folder: str) -> DataFrame:
    """Message bytes as the stream delivers them (well-formed and malformed)."""
    path, marks = new_folder(spark, "bytes"), new_folder(spark, "marks")
    stream = b.as_messages(event_stream(spark, folder), b.payload())
    started = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", marks)
        .trigger(availableNow=True)
        .start(path)
    )
    started.awaitTermination()
    return spark.read.parquet(path).select(
        "trace_id", sc.readable(F.col("value")).alias("payload")
    )


@query(
    "stream_source_ids",
    with_ctes(
        "SELECT trace_id, CAST(user_id AS VARCHAR) || '_streaming' AS entity_id FROM msgs"
        " WHERE event_type IN ('purchase', 'click', 'view')",
        "msgs",
    ),
)
def stream_source_ids(spark: SparkSession, folder: str) -> DataFrame:
    """The message id stays with a request through parsing."""
    path, marks = new_folder(spark, "traced"), new_folder(spark, "marks")
    stream = b.as_messages(event_stream(spark, folder), b.request())
    parsed = msg.accepted(msg.read_inference_messages(stream)).select("trace_id", "entity_id")
    started = (
        parsed.writeStream.format("parquet")
        .option("checkpointLocation", marks)
        .trigger(availableNow=True)
        .start(path)
    )
    started.awaitTermination()
    return spark.read.parquet(path)


# --- sinks ---------------------------------------------------------------------------------


@query(
    "sink_truncate",
    with_ctes(
        "SELECT entity_id, source, feature_timestamp,"
        " CASE source WHEN 'training' THEN upper(species) END AS species FROM features",
        "features",
    ),
)
def sink_truncate(spark: SparkSession, folder: str) -> DataFrame:
    """A second refresh replaces the partition it writes and leaves the other one alone."""
    path = _stored_features(spark, folder)
    again = b.canonical(spark, folder).where("source = 'training'")
    tables.write_refresh(again.withColumn("species", F.upper("species")), path)
    stored = spark.read.schema(FEATURE_SCHEMA).parquet(path)
    return stored.select("entity_id", "species", "source", "feature_timestamp")


@query(
    "sink_append",
    with_ctes(
        "SELECT entity_id, model_path, sepal_length_cm FROM features,"
        " (VALUES ('run-1'), ('run-2')) AS r(model_path)",
        "features",
    ),
)
def sink_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs accumulate."""
    path = new_folder(spark, "runs")
    rows = b.canonical(spark, folder)
    for run in ("run-1", "run-2"):
        tables.write_append(
            rows.select("entity_id", "sepal_length_cm", F.lit(run).alias("model_path")), path
        )
    return spark.read.parquet(path)


VALID_SQL = """SELECT trace_id, value AS sepal_length,
  CASE event_type WHEN 'purchase' THEN CAST(k AS DOUBLE)
    WHEN 'click' THEN CAST(k AS DOUBLE) + 0.5 ELSE 1.0 END AS sepal_width,
  CAST(1.5 AS DOUBLE) AS petal_length, CAST(0.2 AS DOUBLE) AS petal_width,
  '2026-01-01T00:00:00' AS "timestamp", user_id AS sample_id
FROM msgs WHERE event_type IN ('purchase', 'click', 'view')"""


@query(
    "stream_append",
    with_ctes(
        "SELECT sepal_length AS sepal_length_cm, sepal_width AS sepal_width_cm,"
        " petal_length AS petal_length_cm, petal_width AS petal_width_cm, 'streaming' AS source,"
        f" TIMESTAMP '{b.AS_OF_TEXT}' AS feature_timestamp FROM ({VALID_SQL})",
        "msgs",
    ),
)
def stream_append(spark: SparkSession, folder: str) -> DataFrame:
    """Stream into an existing table with a fixed schema."""
    path, marks = new_folder(spark, "offline"), new_folder(spark, "marks")
    tables.create_table(spark, path, FEATURE_SCHEMA)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = feature_rows(msg.accepted(msg.read_feature_messages(batch)), b.as_of())
        tables.write_batch(rows, path, batch_id, FEATURE_SCHEMA, source=STREAM_SOURCE)

    stream = b.as_messages(event_stream(spark, folder), b.payload())
    start_batches(stream, write, marks).awaitTermination()
    return tables.read_batches(spark, path, FEATURE_SCHEMA).drop("entity_id", "species")


@query(
    "stream_append_day_partitioned",
    with_ctes(
        "SELECT entity_id, prediction, prediction_timestamp,"
        " CAST(prediction_timestamp AS DATE) AS dt,"
        " prediction_timestamp > TIMESTAMP '2024-01-10 12:00:00' AS recent FROM preds",
        "preds",
    ),
)
def stream_append_day_partitioned(spark: SparkSession, folder: str) -> DataFrame:
    """Predictions appended by day; those after a moment are read with a partition predicate."""
    path, marks = new_folder(spark, "predictions"), new_folder(spark, "marks")
    events = event_stream(spark, folder)
    value = F.col("value")
    rows = events.select(
        F.concat(F.col("user_id").cast("string"), F.lit("_streaming")).alias("entity_id"),
        F.when(value < 20, "0").when(value < 60, "1").otherwise("2").alias("prediction"),
        F.col("ts").cast("timestamp").alias("prediction_timestamp"),
    )
    started = (
        tables.day_partitioned(rows, "prediction_timestamp")
        .writeStream.format("parquet")
        .partitionBy("dt")
        .option("checkpointLocation", marks)
        .trigger(availableNow=True)
        .start(path)
    )
    started.awaitTermination()
    stored, moment = spark.read.parquet(path), b.as_of("2024-01-10 12:00:00")
    recent = tables.between_days(stored, "prediction_timestamp", moment)
    earlier = stored.where(F.col("prediction_timestamp") <= moment)
    return recent.withColumn("recent", F.lit(True)).unionByName(
        earlier.withColumn("recent", F.lit(False))
    )


@query(
    "sink_fail_fast",
    with_ctes(
        f"SELECT {_FEATURE_LIST}, species, source, entity_id, feature_timestamp FROM features",
        "features",
    ),
)
def sink_fail_fast(spark: SparkSession, folder: str) -> DataFrame:
    """Rows that meet the sink contract pass; one that does not would fail the job."""
    return conform(b.canonical(spark, folder), FEATURE_SCHEMA, strict=True)


LETTERS_SQL = f"""SELECT CAST(NULL AS VARCHAR) AS entity_id, 'feature' AS pipeline, 'parse' AS stage,
  CASE event_type WHEN 'signup' THEN 'validation' ELSE 'json_decode' END AS error_type,
  CASE event_type WHEN 'signup' THEN 'invalid or missing: sepal_width'
    ELSE 'payload is not a JSON object' END AS error_message,
  CASE event_type WHEN 'signup' THEN head || 'null' || tail || CAST(user_id AS VARCHAR) || '}}'
    ELSE head END AS original_message,
  TIMESTAMP '{b.AS_OF_TEXT}' AS "timestamp", CAST(NULL AS BIGINT) AS retry_count
FROM msgs WHERE event_type IN ('signup', 'error')"""


def _feature_letters(spark: SparkSession, folder: str) -> DataFrame:
    failed = msg.refused(msg.read_feature_messages(b.messages(spark, folder)))
    return msg.dead_letters(failed, "feature", "parse", b.as_of(), payload=F.col("value"))


@query("dead_letter_sink", with_ctes(LETTERS_SQL, "msgs"))
def dead_letter_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "letters")
    tables.create_table(spark, path, DEAD_LETTER_SCHEMA)
    tables.write_batch(_feature_letters(spark, folder), path, 0, DEAD_LETTER_SCHEMA)
    return tables.read_batches(spark, path, DEAD_LETTER_SCHEMA)


@query("build_dead_letter", with_ctes(LETTERS_SQL, "msgs"))
def build_dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    return _feature_letters(spark, folder)


_UPSERT_SQL = """
SELECT CAST(user_id AS VARCHAR) AS entity_id,
  arg_max(value, ts) FILTER (WHERE event_type = 'purchase') AS last_purchase,
  arg_max(value, ts) FILTER (WHERE event_type = 'click') AS last_click,
  arg_max(event_type, ts) AS last_type, max(ts) AS feature_timestamp
FROM events GROUP BY user_id"""


@query("online_upsert", _UPSERT_SQL)
def online_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches of partial rows; a null feature keeps the value stored before."""
    kind = F.col("event_type")
    rows = b.load(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("entity_id"),
        F.when(kind == "purchase", F.col("value")).alias("last_purchase"),
        F.when(kind == "click", F.col("value")).alias("last_click"),
        kind.alias("last_type"),
        F.col("ts").alias("feature_timestamp"),
    )
    store = online.new_store(spark, "entity_id", ["last_purchase", "last_click", "last_type"])
    half = b.as_of("2024-01-16 00:00:00")
    store.upsert(rows.where(F.col("feature_timestamp") < half), 0)
    store.upsert(rows.where(F.col("feature_timestamp") >= half), 1)
    return store.snapshot().drop("batch_id")


_LATEST = f"SELECT entity_id, {_FEATURE_LIST}, feature_timestamp FROM latest"


@query(
    "online_sync",
    with_ctes(
        f"""SELECT entity_id, {_FEATURE_LIST}, feature_timestamp FROM (
          SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY feature_timestamp DESC,
            sepal_length_cm DESC, sepal_width_cm DESC, petal_length_cm DESC,
            petal_width_cm DESC) AS rn FROM features) WHERE rn = 1""",
        "features",
    ),
)
def online_sync(spark: SparkSession, folder: str) -> DataFrame:
    store = online.new_store(spark, "entity_id", b.FEATURES)
    store.sync(b.canonical(spark, folder))
    return store.snapshot().drop("batch_id")


@query("feature_view", with_ctes(_LATEST, "latest"))
def feature_view(spark: SparkSession, folder: str) -> DataFrame:
    online.feature_view(b.canonical(spark, folder), "iris_features", "entity_id", b.FEATURE_ORDER)
    return spark.sql(
        f"SELECT entity_id, {_FEATURE_LIST}, feature_timestamp FROM iris_features"
    )


SPLIT_KEY = ["Id", "SepalWidthCm"]
_DIGEST = (
    'md5(concat_ws(\'|\', CAST("Id" AS VARCHAR), CAST("SepalWidthCm" AS VARCHAR),'
    " '{seed}'))"
)
SPLIT_SQL = f"""SELECT * EXCLUDE (rn, n), CASE WHEN rn <= ceil(n * CAST(0.2 AS DOUBLE))
  THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY {_DIGEST.format(seed=42)}) AS rn,
  count(*) OVER () AS n FROM raw)"""
NESTED_SQL = f"""SELECT * EXCLUDE (rn, n), CASE WHEN rn <= ceil(n * CAST(0.2 AS DOUBLE))
  THEN 'holdout' ELSE 'fit' END AS split
FROM (SELECT * EXCLUDE (split), row_number() OVER (ORDER BY {_DIGEST.format(seed=43)}) AS rn,
  count(*) OVER () AS n FROM ({SPLIT_SQL}) WHERE split = 'train')
UNION ALL SELECT * FROM ({SPLIT_SQL}) WHERE split = 'test'"""


@query("split_write", with_ctes(f'SELECT "Id", source, split FROM ({SPLIT_SQL})', "raw"))
def split_write(spark: SparkSession, folder: str) -> DataFrame:
    """Train and test as separate partitions of one stored data set."""
    rows = splits.train_test_split(b.raw(spark, folder), SPLIT_KEY)
    return stored_split(rows).select("Id", "source", "split")


def stored_split(rows: DataFrame) -> DataFrame:
    """A split data set, written once and read back."""
    path = new_folder(rows.sparkSession, "split")
    rows.write.partitionBy("split").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path).select(*rows.columns)


_PR = """SELECT score AS threshold,
    sum(sum(label)) OVER (ORDER BY score DESC) AS tp,
    sum(count(*)) OVER (ORDER BY score DESC) AS support,
    (SELECT sum(label) FROM scored) AS positives
  FROM scored GROUP BY score"""
_CHOSEN = f"""SELECT threshold, CAST(tp AS DOUBLE) / support AS "precision",
    CAST(tp AS DOUBLE) / positives AS recall, CAST(support AS BIGINT) AS support
  FROM ({_PR}) WHERE CAST(tp AS DOUBLE) / support >= 0.2 AND support >= 50
  ORDER BY recall DESC, threshold LIMIT 1"""


def chosen_threshold(spark: SparkSession, folder: str) -> DataFrame:
    curve = evaluate.pr_curve(b.scored(spark, folder), "score", "label")
    return evaluate.select_threshold(curve, target_precision=0.2, min_support=50)


@query(
    "threshold_table_append",
    with_ctes(
        "SELECT 'v' || CAST(v AS VARCHAR) AS model_version, threshold,"
        ' CAST(0.2 AS DOUBLE) AS target_precision, "precision" AS precision_on_test,'
        " recall AS recall_on_test, support AS calib_positives,"
        f" TIMESTAMP '{b.AS_OF_TEXT}' AS selected_at, true AS is_active"
        f" FROM ({_CHOSEN}), (VALUES (1), (2)) AS t(v)",
        "scored",
    ),
)
def threshold_table_append(spark: SparkSession, folder: str) -> DataFrame:
    """One configuration row per model version, read back as the active ones."""
    path = new_folder(spark, "thresholds")
    for version in ("v1", "v2"):
        chosen = chosen_threshold(spark, folder)
        tables.write_append(evaluate.threshold_row(chosen, version, 0.2, b.as_of()), path)
    return evaluate.active_thresholds(spark.read.parquet(path))


@query(
    "prediction_log",
    with_ctes(
        "SELECT transfer_id, sender_id, source_amount / 1000 AS fraud_score,"
        " source_amount / 1000 >= 0.05 AS is_fraud, 'v1' AS model_version,"
        " CAST(0.05 AS DOUBLE) AS threshold, source_amount AS logged_amount,"
        f" TIMESTAMP '{b.AS_OF_TEXT}' AS scored_at FROM transfers",
        "transfers",
    ),
)
def prediction_log(spark: SparkSession, folder: str) -> DataFrame:
    log = scoring.prediction_log(
        b.transfers(spark, folder),
        ["source_amount", "recipient_id"],
        F.col("source_amount") / 1000,
        0.05,
        "v1",
        b.as_of(),
    )
    amount = F.get_json_object("features", "$.source_amount").cast("double")
    return log.withColumn("logged_amount", amount).drop("features")


# --- projections and scalar functions --------------------------------------------------------


@query(
    "rename_columns",
    with_ctes(
        'SELECT "Id", sepal_length_cm, sepal_width_cm, petal_length_cm, petal_width_cm, species'
        ' FROM (SELECT "Id", "SepalLengthCm" AS sepal_length_cm, "SepalWidthCm" AS sepal_width_cm,'
        ' "PetalLengthCm" AS petal_length_cm, "PetalWidthCm" AS petal_width_cm,'
        ' "Species" AS species FROM raw)',
        "raw",
    ),
)
def rename(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.raw(spark, folder).drop("source", "load_timestamp")
    return rename_columns(rows, IRIS.renames("camel"))


@query(
    "canonical_to_source",
    with_ctes(
        'SELECT "SepalLengthCm", "SepalWidthCm", "PetalLengthCm", "PetalWidthCm", "Species"'
        " FROM raw",
        "raw",
    ),
)
def canonical_to_source(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.canonical(spark, folder).select(*b.FEATURES, "species")
    return rename_columns(rows, IRIS.to_source("camel"))


@query(
    "feature_contract",
    with_ctes(
        f"SELECT {_FEATURE_LIST}, species, source, entity_id, feature_timestamp FROM features",
        "features",
    ),
)
def feature_contract(spark: SparkSession, folder: str) -> DataFrame:
    return conform(b.canonical(spark, folder, contract("iris")), FEATURE_SCHEMA)


@query(
    "map_to_feature_row",
    with_ctes(
        "SELECT sepal_length AS sepal_length_cm, sepal_width AS sepal_width_cm,"
        " petal_length AS petal_length_cm, petal_width AS petal_width_cm,"
        " CAST(NULL AS VARCHAR) AS species, 'streaming' AS source,"
        f" TIMESTAMP '{b.AS_OF_TEXT}' AS feature_timestamp FROM ({VALID_SQL})",
        "msgs",
    ),
)
def map_to_feature_row(spark: SparkSession, folder: str) -> DataFrame:
    valid = msg.accepted(msg.read_feature_messages(b.messages(spark, folder)))
    return feature_rows(valid, b.as_of()).drop("entity_id", "trace_id")


@query("entity_id_batch", with_ctes("SELECT entity_id FROM features", "features"))
def entity_id_batch(spark: SparkSession, folder: str) -> DataFrame:
    return b.raw(spark, folder).select(
        sc.batch_entity_id(F.col("Id"), F.col("source")).alias("entity_id")
    )


@query(
    "entity_id_stream",
    "SELECT event_id, CASE WHEN user_id = 0 THEN 'random'"
    " ELSE CAST(user_id AS VARCHAR) || '_streaming' END AS entity_id FROM events",
)
def entity_id_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Id 0 gets a random one, shown here as 'random' after checking its form."""
    ids = b.load(spark, folder, "events").select(
        "event_id", "user_id", sc.stream_entity_id(F.col("user_id")).alias("id")
    )
    drawn = (F.col("user_id") == 0) & F.col("id").rlike("^[0-9a-f]{8}_streaming$")
    return ids.select("event_id", F.when(drawn, "random").otherwise(F.col("id")).alias("entity_id"))


@query(
    "entity_id_resolve",
    with_ctes(
        "SELECT trace_id, CASE WHEN event_type IN ('purchase', 'click', 'view')"
        " THEN CAST(user_id AS VARCHAR) || '_streaming' END AS entity_id,"
        " CASE event_type WHEN 'error' THEN 'missing_field' WHEN 'signup' THEN 'json_decode' END"
        " AS error_type FROM msgs",
        "msgs",
    ),
)
def entity_id_resolve(spark: SparkSession, folder: str) -> DataFrame:
    return msg.read_inference_messages(b.requests(spark, folder)).select(
        "trace_id", "entity_id", F.col("error.error_type").alias("error_type")
    )


@query(
    "const_columns",
    with_ctes(
        "SELECT \"Id\", 'batch_input' AS source, CAST(NULL AS VARCHAR) AS \"Species\","
        f" TIMESTAMP '{b.AS_OF_TEXT}' AS load_timestamp FROM raw",
        "raw",
    ),
)
def const_columns(spark: SparkSession, folder: str) -> DataFrame:
    return b.raw(spark, folder).select(
        "Id",
        F.lit("batch_input").alias("source"),
        F.lit(None).cast("string").alias("Species"),
        b.as_of().alias("load_timestamp"),
    )


@query(
    "timestamp_default",
    with_ctes(
        'SELECT "Id", load_timestamp AS feature_timestamp FROM raw'
        f" UNION ALL SELECT \"Id\", TIMESTAMP '{b.AS_OF_TEXT}' FROM raw",
        "raw",
    ),
)
def timestamp_default(spark: SparkSession, folder: str) -> DataFrame:
    """With and without a load time column."""
    rows = b.raw(spark, folder)
    bare = rows.drop("load_timestamp")
    return rows.select(
        "Id", default_timestamp(rows, b.as_of()).alias("feature_timestamp")
    ).unionByName(bare.select("Id", default_timestamp(bare, b.as_of()).alias("feature_timestamp")))


@query("keep_columns", with_ctes(f"SELECT {_FEATURE_LIST}, source FROM features", "features"))
def keep(spark: SparkSession, folder: str) -> DataFrame:
    return keep_columns(b.canonical(spark, folder), [*b.FEATURES, "not_there", "source"])


@query("drop_if_exists", with_ctes(f"SELECT {_FEATURE_LIST}, species FROM features", "features"))
def drop_if_exists(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.canonical(spark, folder)
    return rows.drop("entity_id", "feature_timestamp", "source", "not_there")


@query(
    "label_encode",
    with_ctes(
        "SELECT entity_id, CASE species WHEN 'Iris-versicolor' THEN '0'"
        " WHEN 'Iris-virginica' THEN '1' WHEN 'Iris-setosa' THEN '2' ELSE species END AS species"
        " FROM features",
        "features",
    ),
)
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    return b.canonical(spark, folder).select(
        "entity_id", sc.label_code(F.col("species")).alias("species")
    )


@query(
    "label_normalise",
    "SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'Iris-setosa'"
    " WHEN 'N' THEN 'Iris-versicolor' ELSE l_returnflag END AS species FROM lineitem",
)
def label_normalise(spark: SparkSession, folder: str) -> DataFrame:
    """Known names get their prefix, others (here the flag R) pass through."""
    flag = F.col("l_returnflag")
    named = F.when(flag == "A", "Setosa").when(flag == "N", "Versicolor").otherwise(flag)
    rows = b.load(spark, folder, "lineitem").select("l_orderkey", named.alias("species"))
    return rows.na.replace(sc.LABEL_NAMES, subset=["species"])


@query("feature_vector", with_ctes(f"SELECT entity_id, {_FEATURE_LIST} FROM features", "features"))
def feature_vector(spark: SparkSession, folder: str) -> DataFrame:
    return b.canonical(spark, folder).select("entity_id", *IRIS.features)


@query("features_json", with_ctes(f"SELECT entity_id, {_FEATURE_LIST} FROM features", "features"))
def features_json(spark: SparkSession, folder: str) -> DataFrame:
    """The JSON snapshot, compared by the values it holds."""
    rows = b.canonical(spark, folder).select(
        "entity_id", sc.features_json(IRIS.features).alias("features")
    )
    return rows.select(
        "entity_id",
        *[F.get_json_object("features", f"$.{n}").cast("double").alias(n) for n in b.FEATURES],
    )


@query(
    "prediction_string",
    "SELECT event_id, CASE event_type WHEN 'error' THEN 'unknown'"
    " ELSE CAST(user_id % 3 AS VARCHAR) END AS prediction FROM events",
)
def prediction_string(spark: SparkSession, folder: str) -> DataFrame:
    replied = F.when(F.col("event_type") != "error", F.col("user_id") % 3)
    return b.load(spark, folder, "events").select(
        "event_id", sc.prediction_text(replied).alias("prediction")
    )


def rule_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The canonical table scored by the threshold rule on the third feature."""
    rows = b.canonical(spark, folder).withColumn("timestamp", F.lit(None).cast("string"))
    return scoring.score_rows(rows, b.FEATURES, scoring.ThresholdRule(2, 0.03, 0.07))


@query(
    "per_element_time", with_ctes("SELECT entity_id, true AS timed FROM features", "features")
)
def per_element_time(spark: SparkSession, folder: str) -> DataFrame:
    """Every scored row has its share of the group's time (the number depends on the machine)."""
    share = F.col("processing_time")
    return rule_scores(spark, folder).select("entity_id", (share >= 0).alias("timed"))


@query(
    "processing_stamp",
    with_ctes(
        f"SELECT entity_id, TIMESTAMP '{b.AS_OF_TEXT}' AS dataflow_processing_time FROM features",
        "features",
    ),
)
def processing_stamp(spark: SparkSession, folder: str) -> DataFrame:
    made = scoring.predictions(rule_scores(spark, folder), b.FEATURES, b.SERVICE, b.as_of())
    return made.select("entity_id", "dataflow_processing_time")


@query(
    "truncate_error",
    "SELECT doc_id, substr(text, 1, 2048) AS error_message FROM documents",
)
def truncate_error(spark: SparkSession, folder: str) -> DataFrame:
    return b.load(spark, folder, "documents").select(
        "doc_id", sc.truncated(F.col("text")).alias("error_message")
    )


@query(
    "safe_serialize",
    "SELECT doc_id, CASE lang WHEN 'en' THEN 'FF' || hex(encode(text)) ELSE text END AS original"
    " FROM documents",
)
def safe_serialize(spark: SparkSession, folder: str) -> DataFrame:
    """Texts as bytes; those of one language get a leading byte that is not UTF-8."""
    text = F.encode("text", "utf-8")
    broken = F.concat(F.unhex(F.lit("FF")), text)
    return b.load(spark, folder, "documents").select(
        "doc_id",
        sc.readable(F.when(F.col("lang") == "en", broken).otherwise(text)).alias("original"),
    )


@query(
    "json_extract",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def json_extract(spark: SparkSession, folder: str) -> DataFrame:
    doc = F.try_parse_json("props")
    return b.load(spark, folder, "events").select(
        "event_id", F.try_variant_get(doc, "$.k", "bigint").alias("k")
    )


@query(
    "user_attribute_flags",
    with_ctes(
        "SELECT user_id, is_business, is_kyc_verified, country_risk_score, label FROM users",
        "users",
    ),
)
def user_attribute_flags(spark: SparkSession, folder: str) -> DataFrame:
    return user_attributes(b.users(spark, folder)).drop("registration_date")


@query(
    "calendar_parts",
    "SELECT event_id, hour(ts) AS hour_of_day, dayofweek(ts) + 1 AS day_of_week FROM events",
)
def calendar_parts(spark: SparkSession, folder: str) -> DataFrame:
    return b.load(spark, folder, "events").select(
        "event_id",
        sc.hour_of_day(F.col("ts")).alias("hour_of_day"),
        sc.day_of_week(F.col("ts")).alias("day_of_week"),
    )


@query(
    "safe_divide",
    "SELECT event_id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE value / (user_id % 5) END AS ratio"
    " FROM events",
)
def safe_divide(spark: SparkSession, folder: str) -> DataFrame:
    return b.load(spark, folder, "events").select(
        "event_id", sc.safe_divide(F.col("value"), F.col("user_id") % 5).alias("ratio")
    )


@query(
    "as_of_age",
    with_ctes(
        "SELECT transfer_id, CASE WHEN t.target_currency <> 'error' THEN"
        " greatest(date_diff('day', u.registered, CAST(created_at AS DATE)), 0) END"
        " AS account_age_days FROM transfers t JOIN users u ON t.sender_id = u.user_id",
        "transfers",
        "users",
    ),
)
def as_of_age(spark: SparkSession, folder: str) -> DataFrame:
    """Age at the time of the transfer; an unknown registration date stays unknown."""
    known = F.when(F.col("target_currency") != "error", F.col("registration_date"))
    people = b.users(spark, folder).select("user_id", "registration_date")
    return (
        b.transfers(spark, folder)
        .join(people, F.col("sender_id") == F.col("user_id"))
        .select(
            "transfer_id",
            sc.days_since(known, F.col("created_at")).alias("account_age_days"),
        )
    )


# --- set operations --------------------------------------------------------------------------


@query(
    "outer_union",
    with_ctes(
        'SELECT "Id", source, "Species" FROM raw WHERE source = \'training\' UNION ALL'
        ' SELECT "Id", source, NULL FROM raw WHERE source = \'batch_input\'',
        "raw",
    ),
)
def outer_union(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.raw(spark, folder)
    labelled = rows.where("source = 'training'").select("Id", "source", "Species")
    plain = rows.where("source = 'batch_input'").select("Id", "source")
    return union_by_name([labelled, None, plain])


@query("distinct_users", "SELECT DISTINCT o_custkey FROM orders")
def distinct_users(spark: SparkSession, folder: str) -> DataFrame:
    return b.load(spark, folder, "orders").select("o_custkey").distinct()


def ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Training and batch-input tables into one canonical table."""
    rows = b.raw(spark, folder)
    parts = [rows.where("source = 'training'"), rows.where("source = 'batch_input'")]
    return canonicalise(parts, IRIS, b.as_of())
