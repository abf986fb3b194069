"""Aggregations, windows, rings and investigations (A, W, T and the batch R rows)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import SCALARS, USER_ATTRIBUTES
from tidemark.functions import scalars as sc
from tidemark.operators import evaluate, investigate, rings, splits, velocity
from tidemark.operators.canonical import append_with_next_id
from tidemark.plans import bindings as b
from tidemark.plans.bindings import with_ctes
from tidemark.plans.registry import query
from tidemark.plans.tables import chosen_threshold


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, digits) for n in names})


# --- ids, accuracy, choice ---------------------------------------------------------------------

_ROW_DIGEST = """md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
  CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR), '0'))"""


@query(
    "append_with_next_id",
    f"""SELECT (SELECT coalesce(max(o_orderkey), 0) FROM orders)
        + row_number() OVER (ORDER BY {_ROW_DIGEST}) AS "Id",
      l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem""",
)
def next_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Line items numbered on from the largest order key."""
    orders = b.load(spark, folder, "orders").select(F.col("o_orderkey").alias("Id"))
    new = b.load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return append_with_next_id(orders, new)


RULES = {
    "decision_tree": (0.03, 0.07),
    "random_forest": (0.04, 0.08),
}
_RULE_SQL = (
    "CASE WHEN petal_length_cm < {0} THEN 0 WHEN petal_length_cm < {1} THEN 1 ELSE 2 END"
)


def _ruled(spark: SparkSession, folder: str, low: float, high: float) -> DataFrame:
    petal = F.col("petal_length_cm")
    return (
        b.canonical(spark, folder)
        .where("source = 'training'")
        .select(
            sc.label_code_strict(F.col("species")).alias("label"),
            F.when(petal < low, 0).when(petal < high, 1).otherwise(2).alias("predicted"),
        )
    )


@query(
    "accuracy",
    with_ctes(
        f"""SELECT avg(CASE WHEN label = {_RULE_SQL.format(0.03, 0.07)} THEN 1.0 ELSE 0.0 END)
          AS accuracy FROM trained""",
        "trained",
    ),
)
def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.accuracy(_ruled(spark, folder, 0.03, 0.07), "label", "predicted")


@query(
    "choose_best",
    with_ctes(
        "SELECT model, accuracy FROM ("
        + " UNION ALL ".join(
            f"SELECT '{name}' AS model, avg(CASE WHEN label = {_RULE_SQL.format(*rule)}"
            " THEN 1.0 ELSE 0.0 END) AS accuracy FROM trained"
            for name, rule in RULES.items()
        )
        + ") ORDER BY accuracy DESC, CASE model WHEN 'random_forest' THEN 0 ELSE 1 END LIMIT 1",
        "trained",
    ),
)
def choose_best(spark: SparkSession, folder: str) -> DataFrame:
    metrics = None
    for name, (low, high) in RULES.items():
        row = evaluate.accuracy(_ruled(spark, folder, low, high), "label", "predicted").select(
            F.lit(name).alias("model"), "accuracy"
        )
        metrics = row if metrics is None else metrics.unionByName(row)
    return evaluate.choose_best(metrics)


# --- predictions and dead letters ----------------------------------------------------------------

_RUNS = """SELECT date_trunc('day', prediction_timestamp) AS prediction_timestamp,
  entity_id, prediction FROM preds"""


@query(
    "run_sizes",
    with_ctes(
        f"""SELECT prediction_timestamp, count(*) AS row_count,
          count(DISTINCT prediction) AS distinct_classes FROM ({_RUNS})
        GROUP BY 1 ORDER BY 1 DESC LIMIT 10""",
        "preds",
    ),
)
def run_sizes(spark: SparkSession, folder: str) -> DataFrame:
    return investigate.run_sizes(b.run_predictions(spark, folder))


@query(
    "prediction_distribution",
    with_ctes(
        f"""SELECT date_trunc('hour', prediction_timestamp) AS hour, prediction,
          count(*) AS predictions FROM preds
        WHERE prediction_timestamp > TIMESTAMP '{b.AS_OF_TEXT}' - INTERVAL 24 HOUR
        GROUP BY 1, 2""",
        "preds",
    ),
)
def prediction_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return investigate.prediction_distribution(b.stream_predictions(spark, folder), b.as_of())


@query(
    "latest_run",
    with_ctes(
        f"""SELECT * FROM ({_RUNS}) WHERE prediction_timestamp =
          (SELECT max(date_trunc('day', prediction_timestamp)) FROM preds)""",
        "preds",
    ),
)
def latest_run(spark: SparkSession, folder: str) -> DataFrame:
    return investigate.latest_run(b.run_predictions(spark, folder))


@query(
    "dead_letter_rates",
    with_ctes(
        f"""SELECT pipeline, stage, error_type, count(*) AS dead_letters FROM letters
        WHERE "timestamp" > TIMESTAMP '{b.AS_OF_TEXT}' - INTERVAL 24 HOUR GROUP BY ALL""",
        "letters",
    ),
)
def dead_letter_rates(spark: SparkSession, folder: str) -> DataFrame:
    return investigate.dead_letter_rates(b.letters(spark, folder), b.as_of(), hours=24)


@query(
    "entity_trace",
    with_ctes(
        """SELECT trace_id, entity_id, prediction_timestamp, prediction FROM preds
        WHERE entity_id = '42_streaming' ORDER BY prediction_timestamp DESC LIMIT 10""",
        "preds",
    ),
)
def entity_trace(spark: SparkSession, folder: str) -> DataFrame:
    made = b.stream_predictions(spark, folder)
    return investigate.entity_trace(made, "42_streaming").select(
        "trace_id", "entity_id", "prediction_timestamp", "prediction"
    )


@query(
    "slow_predictions",
    with_ctes(
        """SELECT entity_id, trace_id, feature_fetch_latency_ms, feature_fetch_retry_count,
          prediction_retry_count, processing_time, CAST(value AS VARCHAR) AS sepal_length
        FROM preds WHERE prediction_timestamp > TIMESTAMP '2024-01-20 00:00:00'
          AND (feature_fetch_retry_count > 0 OR prediction_retry_count > 0)""",
        "preds",
    ),
)
def slow_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return investigate.slow_predictions(
        b.stream_predictions(spark, folder), b.as_of("2024-01-20 00:00:00")
    )


@query(
    "sort_for_cv",
    with_ctes(
        "SELECT transfer_id, sender_id, created_at, source_amount FROM transfers", "transfers"
    ),
)
def sort_for_cv(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.transfers(spark, folder)
    return rows.select("transfer_id", "sender_id", "created_at", "source_amount").orderBy(
        "created_at"
    )


# --- evaluation ------------------------------------------------------------------------------------


@query(
    "confusion_matrix",
    with_ctes(
        """SELECT label, count(*) FILTER (WHERE score < 0.1) AS predicted_0,
          count(*) FILTER (WHERE score >= 0.1) AS predicted_1 FROM scored GROUP BY label""",
        "scored",
    ),
)
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.scored(spark, folder).withColumn("predicted", sc.flag(F.col("score") >= 0.1))
    return evaluate.confusion_matrix(rows, "label", "predicted", [0, 1])


@query(
    "roc_curve",
    with_ctes(
        """SELECT threshold, CAST(fp AS DOUBLE) / n AS fpr, CAST(tp AS DOUBLE) / p AS tpr
        FROM (SELECT score AS threshold, sum(sum(label)) OVER (ORDER BY score DESC) AS tp,
            sum(sum(1 - label)) OVER (ORDER BY score DESC) AS fp
          FROM scored GROUP BY score),
          (SELECT sum(label) AS p, sum(1 - label) AS n FROM scored)""",
        "scored",
    ),
)
def roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.roc_curve(b.scored(spark, folder), "score", "label")


@query(
    "pr_curve",
    with_ctes(
        """SELECT threshold, CAST(tp AS DOUBLE) / support AS "precision",
          CAST(tp AS DOUBLE) / p AS recall, CAST(support AS BIGINT) AS support
        FROM (SELECT score AS threshold, sum(sum(label)) OVER (ORDER BY score DESC) AS tp,
            sum(count(*)) OVER (ORDER BY score DESC) AS support
          FROM scored GROUP BY score), (SELECT sum(label) AS p FROM scored)""",
        "scored",
    ),
)
def pr_curve(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.pr_curve(b.scored(spark, folder), "score", "label")


@query(
    "select_threshold",
    with_ctes(
        """SELECT threshold, "precision", recall, support FROM (
          SELECT threshold, CAST(tp AS DOUBLE) / support AS "precision",
            CAST(tp AS DOUBLE) / p AS recall, CAST(support AS BIGINT) AS support
          FROM (SELECT score AS threshold, sum(sum(label)) OVER (ORDER BY score DESC) AS tp,
              sum(count(*)) OVER (ORDER BY score DESC) AS support
            FROM scored GROUP BY score), (SELECT sum(label) AS p FROM scored))
        WHERE "precision" >= 0.2 AND support >= 50
        ORDER BY recall DESC, threshold LIMIT 1""",
        "scored",
    ),
)
def select_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_threshold(spark, folder)


@query(
    "brier_ece",
    with_ctes(
        """SELECT round(brier, 9) AS brier, round(ece, 9) AS ece FROM
        (SELECT avg(pow(score - label, 2)) AS brier FROM scored),
        (SELECT sum(n * abs(s - o)) / sum(n) AS ece FROM (
          SELECT count(*) AS n, avg(score) AS s, avg(label) AS o FROM scored
          GROUP BY least(9, floor(score * 10))))""",
        "scored",
    ),
)
def brier_ece(spark: SparkSession, folder: str) -> DataFrame:
    rows = b.scored(spark, folder)
    both = evaluate.brier_score(rows, "score", "label").withColumn(
        "ece", evaluate.expected_calibration_error(rows, "score", "label").scalar()
    )
    return rounded(both, 9, "brier", "ece")


@query(
    "cutoff_percentile",
    "SELECT quantile_cont(epoch_us(o_orderdate), 0.8) AS cutoff_us FROM orders",
)
def cutoff_percentile(spark: SparkSession, folder: str) -> DataFrame:
    return splits.cutoff(b.load(spark, folder, "orders"), "o_orderdate")


# --- trailing windows --------------------------------------------------------------------------------


def _windowed(spark: SparkSession, folder: str) -> DataFrame:
    return velocity.with_windows(b.transfers(spark, folder))


@query(
    "velocity_counts",
    with_ctes(
        "SELECT transfer_id, tx_count_1h, tx_count_24h, tx_count_7d, tx_count_30d FROM windows",
        "windows",
    ),
)
def velocity_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _windowed(spark, folder).select(
        "transfer_id", "tx_count_1h", "tx_count_24h", "tx_count_7d", "tx_count_30d"
    )


@query(
    "amount_windows",
    with_ctes(
        """SELECT transfer_id, round(avg_amount_7d, 8) AS avg_amount_7d, max_amount_7d,
          round(total_amount_24h, 8) AS total_amount_24h FROM windows""",
        "windows",
    ),
)
def amount_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = _windowed(spark, folder).select(
        "transfer_id", "avg_amount_7d", "max_amount_7d", "total_amount_24h"
    )
    return rounded(rows, 8, "avg_amount_7d", "total_amount_24h")


@query(
    "distinct_in_window",
    with_ctes(
        "SELECT transfer_id, unique_recipients_7d, unique_currencies_7d FROM windows", "windows"
    ),
)
def distinct_in_window(spark: SparkSession, folder: str) -> DataFrame:
    return _windowed(spark, folder).select(
        "transfer_id", "unique_recipients_7d", "unique_currencies_7d"
    )


@query(
    "cross_border_ratio",
    with_ctes(
        "SELECT transfer_id, round(cross_border_ratio_7d, 9) AS cross_border_ratio_7d"
        " FROM windows",
        "windows",
    ),
)
def cross_border_ratio(spark: SparkSession, folder: str) -> DataFrame:
    rows = _windowed(spark, folder).select("transfer_id", "cross_border_ratio_7d")
    return rounded(rows, 9, "cross_border_ratio_7d")


@query(
    "amount_ratio",
    with_ctes(
        """SELECT transfer_id, round(CASE WHEN avg_amount_7d <> 0
          THEN source_amount / avg_amount_7d END, 9) AS amount_ratio_to_avg FROM windows""",
        "windows",
    ),
)
def amount_ratio(spark: SparkSession, folder: str) -> DataFrame:
    ratio = sc.safe_divide(F.col("source_amount"), F.col("avg_amount_7d"))
    return _windowed(spark, folder).select(
        "transfer_id", F.round(ratio, 9).alias("amount_ratio_to_avg")
    )


@query(
    "transfer_features",
    with_ctes(
        f"""SELECT entity_id, transfer_id, sender_id, source, source_amount, created_at,
          is_cross_border, hour(created_at) AS hour_of_day, dayofweek(created_at) + 1 AS day_of_week,
          tx_count_1h, tx_count_24h, tx_count_7d, tx_count_30d,
          round(avg_amount_7d, 8) AS avg_amount_7d, max_amount_7d,
          round(total_amount_24h, 8) AS total_amount_24h,
          round(cross_border_ratio_7d, 9) AS cross_border_ratio_7d,
          unique_recipients_7d, unique_currencies_7d, account_age_days, is_business,
          is_kyc_verified, country_risk_score, round(amount_ratio_to_avg, 9)
            AS amount_ratio_to_avg, label, TIMESTAMP '{b.AS_OF_TEXT}' AS feature_timestamp
        FROM transfer_features""",
        "transfer_features",
    ),
)
def transfer_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = velocity.transfer_features(
        b.transfers(spark, folder), b.users(spark, folder), b.as_of()
    )
    rows = rounded(rows, 8, "avg_amount_7d", "total_amount_24h")
    return rounded(rows, 9, "cross_border_ratio_7d", "amount_ratio_to_avg")


_MEANS_SQL = (
    "SELECT "
    + ", ".join(f"avg({c}) AS global_{c}" for c in SCALARS)
    + ", "
    + ", ".join(f"avg({c}) AS {c}" for c in USER_ATTRIBUTES)
    + " FROM transfer_features"
)
_GLOBAL_SQL = f"SELECT round(COLUMNS(*), 6) FROM ({_MEANS_SQL})"


def _transfer_rows(spark: SparkSession, folder: str) -> DataFrame:
    return velocity.transfer_features(
        b.transfers(spark, folder), b.users(spark, folder), b.as_of()
    )


def _global_row(spark: SparkSession, folder: str) -> DataFrame:
    return rings.global_averages(_transfer_rows(spark, folder))


@query(
    "global_averages",
    with_ctes(
        f"""SELECT '__global__' AS user_id, CAST(NULL AS INTEGER) AS label, * FROM ({_GLOBAL_SQL})
        UNION ALL BY NAME
        SELECT CAST(user_id AS VARCHAR) AS user_id, is_business, is_kyc_verified,
          country_risk_score, label FROM users""",
        "transfer_features",
    ),
)
def global_averages(spark: SparkSession, folder: str) -> DataFrame:
    """User rows plus the cold-start row."""
    people = velocity.user_attributes(b.users(spark, folder)).select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("is_business").cast("double").alias("is_business"),
        F.col("is_kyc_verified").cast("double").alias("is_kyc_verified"),
        "country_risk_score",
        "label",
    )
    everyone = rings.with_global_row(people, _transfer_rows(spark, folder))
    averaged = [f"global_{c}" for c in SCALARS] + list(USER_ATTRIBUTES)
    return rounded(everyone, 6, *averaged)


# --- rings ---------------------------------------------------------------------------------------------


def _bucket_sql(unit: str, span: int, currencies: bool) -> str:
    extra = (
        """, array_to_string(list_sort(list(DISTINCT target_currency)), ',') AS currencies"""
        if currencies
        else ""
    )
    return f"""SELECT sender_id AS user_id, {unit} AS bucket, count(*) AS tx_count,
      round(sum(source_amount), 6) AS amount_sum, max(source_amount) AS amount_max,
      CAST(sum(is_cross_border) AS BIGINT) AS cross_border_count,
      array_to_string(list_sort(list(DISTINCT recipient_id)), ',') AS recipients{extra}
    FROM recent WHERE sec >= now - {span} AND sec <= now GROUP BY sender_id, {unit}"""


def _shown(bucketed: DataFrame, *lists: str) -> DataFrame:
    return bucketed.withColumns(
        {n: F.array_join(n, ",") for n in lists} | {"amount_sum": F.round("amount_sum", 6)}
    )


@query("hourly_buckets", with_ctes(_bucket_sql("hour", 86_400, False), "recent"))
def hourly_buckets(spark: SparkSession, folder: str) -> DataFrame:
    bucketed = rings.buckets(b.transfers(spark, folder), rings.HOURLY, b.as_of())
    return _shown(bucketed, "recipients")


@query("daily_buckets", with_ctes(_bucket_sql("day", 2_592_000, True), "recent"))
def daily_buckets(spark: SparkSession, folder: str) -> DataFrame:
    bucketed = rings.buckets(b.transfers(spark, folder), rings.DAILY, b.as_of())
    return _shown(bucketed, "recipients", "currencies")


_RING_SQL = f"""SELECT u.user_id, CAST(s.slot AS BIGINT) AS slot,
  coalesce(d.bucket, -1) AS daily_bucket_day, coalesce(d.tx_count, 0) AS daily_tx_count,
  coalesce(d.amount_sum, 0) AS daily_amount_sum, coalesce(d.amount_max, 0) AS daily_amount_max,
  coalesce(d.cross_border_count, 0) AS daily_cross_border_count,
  coalesce(d.recipients, '') AS daily_recipients, coalesce(d.currencies, '') AS daily_currencies
FROM (SELECT DISTINCT sender_id AS user_id FROM recent WHERE sec >= now - 2592000 AND sec <= now) u
CROSS JOIN (SELECT unnest(range(30)) AS slot) s
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY user_id, bucket % 30
    ORDER BY bucket DESC) AS rn
  FROM ({_bucket_sql("day", 2_592_000, True)})) d
  ON d.user_id = u.user_id AND d.bucket % 30 = s.slot AND d.rn = 1"""


@query("ring_arrays", with_ctes(_RING_SQL, "recent"))
def ring_arrays(spark: SparkSession, folder: str) -> DataFrame:
    """Daily ring arrays, shown one row per slot."""
    bucketed = rings.buckets(b.transfers(spark, folder), rings.DAILY, b.as_of())
    arrays = rings.ring_arrays(bucketed, rings.DAILY)
    names = [c for c in arrays.columns if c != "user_id"]
    slots = arrays.select("user_id", F.posexplode(F.arrays_zip(*names)).alias("slot", "s"))
    return slots.select(
        "user_id",
        F.col("slot").cast("bigint").alias("slot"),
        *[F.col(f"s.{n}").alias(n) for n in names],
    ).withColumns(
        {n: F.array_join(n, ",") for n in ("daily_recipients", "daily_currencies")}
        | {"daily_amount_sum": F.round("daily_amount_sum", 6)}
    )


MERGE_SQL = """
SELECT user_id,
  count(*) FILTER (WHERE hour = now // 3600) AS tx_count_1h,
  count(*) FILTER (WHERE hour > now // 3600 - 24) AS tx_count_24h,
  count(*) FILTER (WHERE d7) AS tx_count_7d, count(*) FILTER (WHERE d30) AS tx_count_30d,
  round(avg(source_amount) FILTER (WHERE d7), 8) AS avg_amount_7d,
  max(source_amount) FILTER (WHERE d7) AS max_amount_7d,
  round(coalesce(sum(source_amount) FILTER (WHERE hour > now // 3600 - 24), 0), 8)
    AS total_amount_24h,
  round(avg(CAST(is_cross_border AS DOUBLE)) FILTER (WHERE d7), 9) AS cross_border_ratio_7d,
  count(DISTINCT recipient_id) FILTER (WHERE d7) AS unique_recipients_7d,
  count(DISTINCT target_currency) FILTER (WHERE d7) AS unique_currencies_7d
FROM (SELECT sender_id AS user_id, *, day > now // 86400 - 7 AS d7, day > now // 86400 - 30 AS d30
  FROM (SELECT * REPLACE (epoch_us(TIMESTAMP '{moment}') // 1000000 AS now) FROM recent)
  WHERE sec <= now AND sec >= now - 2592000) GROUP BY user_id"""

MOMENT = "2024-01-30 20:30:00"


def merged(spark: SparkSession, folder: str, moment: Column) -> DataFrame:
    rows = rings.user_rings(b.transfers(spark, folder), moment)
    return rings.read_time_merge(rows, moment)


def shown_scalars(df: DataFrame) -> DataFrame:
    df = rounded(df, 8, "avg_amount_7d", "total_amount_24h")
    return rounded(df, 9, "cross_border_ratio_7d")


@query("read_time_merge", with_ctes(MERGE_SQL.format(moment=MOMENT), "recent"))
def read_time_merge(spark: SparkSession, folder: str) -> DataFrame:
    return shown_scalars(merged(spark, folder, b.as_of(MOMENT)))


_STATE_SQL = f"""
SELECT c_custkey AS user_id, state, """ + ", ".join(
    f"""round(CASE state WHEN 'global' THEN g.global_{c}
      WHEN 'stale' THEN {'NULL' if c in ('avg_amount_7d', 'max_amount_7d', 'cross_border_ratio_7d')
                         else '0'} ELSE CAST(m.{c} AS DOUBLE) END, 6) AS {c}"""
    for c in SCALARS
) + f""" FROM (SELECT c_custkey, CASE WHEN last_sec IS NULL THEN 'global'
    WHEN epoch_us(TIMESTAMP '{MOMENT}') // 1000000 - last_sec > 36000 THEN 'stale'
    ELSE 'live' END AS state
  FROM customer LEFT JOIN (SELECT sender_id, max(sec) AS last_sec FROM recent
    WHERE created_at <= TIMESTAMP '{MOMENT}' GROUP BY 1) l
    ON c_custkey = l.sender_id) c
LEFT JOIN ({MERGE_SQL.format(moment=MOMENT)}) m ON m.user_id = c_custkey
CROSS JOIN ({_MEANS_SQL}) g"""


@query("three_state_fallback", with_ctes(_STATE_SQL, "recent", "transfer_features"))
def three_state_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Unknown users get averages, users silent for ten hours get zeros."""
    moment = b.as_of(MOMENT)
    transfers = b.transfers(spark, folder)
    seen = (
        transfers.where(F.col("created_at") <= moment)
        .groupBy(F.col("sender_id").alias("user_id"))
        .agg(F.max("created_at").alias("feature_timestamp"))
    )
    # Users without a transfer in the rings' span keep their row; their age tells them stale.
    people = seen.join(merged(spark, folder, moment), "user_id", "left")
    asked = b.users(spark, folder).select("user_id")
    result = rings.three_state(asked, people, _global_row(spark, folder), moment, 36_000)
    return rounded(result, 6, *SCALARS)


# --- splits ------------------------------------------------------------------------------------------


@query(
    "time_series_folds",
    """SELECT o_orderkey, CAST(greatest(0, 5 - (n - rn) // (n // 6)) AS BIGINT) AS fold
    FROM (SELECT o_orderkey, count(*) OVER () AS n, row_number() OVER (
        ORDER BY o_orderdate, md5(CAST(o_orderkey AS VARCHAR))) AS rn FROM orders)""",
)
def time_series_folds(spark: SparkSession, folder: str) -> DataFrame:
    return folded_orders(spark, folder).select("o_orderkey", "fold")


def folded_orders(spark: SparkSession, folder: str) -> DataFrame:
    digest = F.md5(F.col("o_orderkey").cast("string"))
    rows = b.load(spark, folder, "orders").withColumn("_digest", digest)
    return splits.time_series_folds(
        rows,
        order=[F.col("o_orderdate"), F.col("_digest")],
        chunk=[F.col("o_orderdate"), F.substring("_digest", 1, 2)],
    ).drop("_digest")


@query(
    "split_floor_check",
    with_ctes(
        """SELECT split, count(*) AS "rows", count(*) FILTER (WHERE label = 1) AS positives
        FROM (SELECT CASE WHEN CAST(concat('0x', substr(md5(concat(user_id, '|42')), 1, 8))
            AS BIGINT) % 100 < 20 THEN 'calib' ELSE 'fit' END AS split, label FROM users)
        GROUP BY split""",
        "users",
    ),
)
def split_floor_check(spark: SparkSession, folder: str) -> DataFrame:
    people = b.users(spark, folder).withColumn(
        "split", F.when(sc.hash_bucket(F.col("user_id"), 42) < 20, "calib").otherwise("fit")
    )
    return splits.split_floor(people, "label", floor=1)


@query(
    "hash_bucket_users",
    """SELECT c_custkey, CAST(concat('0x', substr(md5(concat(CAST(c_custkey AS VARCHAR), '|42')),
      1, 8)) AS BIGINT) % 100 AS bucket FROM customer""",
)
def hash_bucket_users(spark: SparkSession, folder: str) -> DataFrame:
    return b.load(spark, folder, "customer").select(
        "c_custkey", sc.hash_bucket(F.col("c_custkey"), 42).alias("bucket")
    )
