"""Splits, training, scoring and calibration (M rows of the inventory)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import IRIS
from tidemark.functions import scalars as sc
from tidemark.operators import evaluate, scoring, splits, training
from tidemark.plans import bindings as b
from tidemark.plans.analytics import folded_orders
from tidemark.plans.bindings import with_ctes
from tidemark.plans.registry import query
from tidemark.plans.routing import CUTOFF_SQL
from tidemark.plans.tables import (
    NESTED_SQL,
    SPLIT_KEY,
    SPLIT_SQL,
    rule_scores,
    stored_split,
)
from tidemark.session import new_folder
from tidemark.sources import tables


@query("train_test_split", with_ctes(SPLIT_SQL, "raw"))
def train_test_split(spark: SparkSession, folder: str) -> DataFrame:
    return splits.train_test_split(b.raw(spark, folder), SPLIT_KEY)


@query("nested_split", with_ctes(NESTED_SQL, "raw"))
def nested_split(spark: SparkSession, folder: str) -> DataFrame:
    outer = stored_split(splits.train_test_split(b.raw(spark, folder), SPLIT_KEY))
    return splits.nested_split(outer, SPLIT_KEY)


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Training rows with a numeric label and a split, written once and read back.

    Trees pass over their input many times, so it is worth cutting the lineage here.
    """
    rows = b.canonical(spark, folder).where("source = 'training'")
    coded = rows.withColumn("label", sc.label_code_strict(F.col("species")).cast("double"))
    kept = splits.drop_id_columns(coded.withColumn("y", F.col("label"))).drop("species")
    key = ["sepal_width_cm", "petal_length_cm", "y"]
    return stored_split(splits.nested_split(stored_split(splits.train_test_split(kept, key)), key))


def _trained(spark: SparkSession, folder: str, fit, **options) -> DataFrame:
    rows = labelled(spark, folder)
    model = fit(rows.where("split = 'fit'"), b.FEATURES, "y", **options)
    return training.model_accuracy(model, rows.where("split = 'holdout'"), "y")


@query("fit_decision_tree")
def fit_decision_tree(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of the tree on the inner holdout."""
    return _trained(spark, folder, training.fit_decision_tree)


@query("fit_random_forest")
def fit_random_forest(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of the forest on the inner holdout."""
    return _trained(spark, folder, training.fit_random_forest)


@query(
    "score_batches",
    with_ctes(
        f"""SELECT entity_id, CASE WHEN petal_length_cm < 0.03 THEN '0'
            WHEN petal_length_cm < 0.07 THEN '1' ELSE '2' END AS prediction,
          CASE WHEN petal_length_cm < 0.03 THEN 0.8 ELSE 0.1 END::DOUBLE AS p0,
          '{b.SERVICE}' AS model_service, TIMESTAMP '{b.AS_OF_TEXT}' AS prediction_timestamp
        FROM features""",
        "features",
    ),
)
def score_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Rule scores through the batch scorer as prediction rows."""
    made = scoring.predictions(rule_scores(spark, folder), b.FEATURES, b.SERVICE, b.as_of())
    return made.select(
        "entity_id",
        "prediction",
        F.round(F.col("class_probabilities")[0], 6).alias("p0"),
        "model_service",
        "prediction_timestamp",
    )


def small_tree(spark: SparkSession, folder: str):
    """A shallow tree: these queries are about applying a model, not about its quality."""
    rows = b.canonical(spark, folder).where("source = 'training'")
    coded = rows.withColumn("y", sc.label_code_strict(F.col("species")).cast("double"))
    return training.fit_decision_tree(coded, b.FEATURES, "y", depth=5)


def stored_model(spark: SparkSession, folder: str) -> str:
    path = new_folder(spark, "model")
    training.save_model(small_tree(spark, folder), path)
    return path


@query(
    "predict_proba",
    with_ctes(
        "SELECT entity_id, 3 AS classes, true AS sums_to_one, true AS class_is_likeliest"
        " FROM features",
        "features",
    ),
)
def predict_proba(spark: SparkSession, folder: str) -> DataFrame:
    """The reply of a fitted tree for every row: a class and probabilities in class order."""
    model = training.load_model(stored_model(spark, folder))
    scored = training.predict(model, b.canonical(spark, folder))
    chances = F.col("class_probabilities")
    total = F.aggregate(chances, F.lit(0.0), lambda a, p: a + p)
    return scored.select(
        "entity_id",
        F.size(chances).alias("classes"),
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        (F.get(chances, F.col("class_").cast("int")) == F.array_max(chances)).alias(
            "class_is_likeliest"
        ),
    )


@query(
    "batch_inference",
    with_ctes(
        f"SELECT entity_id, source, TIMESTAMP '{b.AS_OF_TEXT}' AS prediction_timestamp,"
        " true AS known_class, true AS has_model_path FROM features WHERE source = 'batch_input'",
        "features",
    ),
)
def batch_inference(spark: SparkSession, folder: str) -> DataFrame:
    """Score the batch-input rows with a stored model and append them."""
    model_path, out = stored_model(spark, folder), new_folder(spark, "scored")
    rows = tables.scan_source(b.canonical(spark, folder), "batch_input")
    model = training.load_model(model_path)
    tables.write_append(training.batch_inference(model, rows, model_path, b.as_of()), out)
    return spark.read.parquet(out).select(
        "entity_id",
        "source",
        "prediction_timestamp",
        F.col("prediction").isin(list(sc.LABEL_CODES.values())).alias("known_class"),
        (F.col("model_path") == model_path).alias("has_model_path"),
    )


@query(
    "save_load_model",
    with_ctes("SELECT entity_id, true AS same FROM features", "features"),
)
def save_load_model(spark: SparkSession, folder: str) -> DataFrame:
    """A reloaded model predicts what the model that was saved predicts, row by row."""
    path = new_folder(spark, "model")
    model = small_tree(spark, folder)
    training.save_model(model, path)
    first = training.predict(model, b.canonical(spark, folder)).select(
        "entity_id",
        *b.FEATURES,
        F.col("class_").alias("before"),
        F.col("class_probabilities").alias("chances"),
    )
    again = training.predict(training.load_model(path), first)
    same = (F.col("class_") == F.col("before")) & (
        F.col("class_probabilities") == F.col("chances")
    )
    return again.select("entity_id", same.alias("same"))


@query(
    "check_feature_names",
    with_ctes(
        f"SELECT entity_id, '{','.join(b.FEATURES)}' AS model_features FROM features", "features"
    ),
)
def check_feature_names(spark: SparkSession, folder: str) -> DataFrame:
    """The stored model's inputs are the contract's features, in order."""
    model = training.load_model(stored_model(spark, folder))
    names = training.check_feature_names(model, IRIS.features)
    scored = training.predict(model, b.canonical(spark, folder))
    return scored.select("entity_id", F.lit(",".join(names)).alias("model_features"))


@query("fit_boosted_binary")
def fit_boosted_binary(spark: SparkSession, folder: str) -> DataFrame:
    """ROC curve on the held-out 30 % of a boosted two-class model."""
    path = new_folder(spark, "vectors")
    rows = b.load(spark, folder, "embeddings").withColumn("y", sc.flag(F.col("label") >= 5))
    splits.train_test_split(rows, ["vec_id"], test_share=0.3).write.parquet(path)
    stored = training.vectors(spark.read.parquet(path), "embedding")
    model = training.fit_boosted(stored.where("split = 'train'"), "features", "y")
    tested = training.predict(model, stored.where("split = 'test'"))
    score = F.col("class_probabilities")[1]
    return evaluate.roc_curve(tested.withColumn("score", score), "score", "y")


@query(
    "time_user_split",
    f"""WITH late AS (SELECT DISTINCT o_custkey FROM orders
        WHERE epoch_us(o_orderdate) >= {CUTOFF_SQL})
    SELECT o_orderkey, o_custkey, CASE WHEN epoch_us(o_orderdate) >= {CUTOFF_SQL} THEN 'test'
      WHEN CAST(concat('0x', substr(md5(concat(CAST(o_custkey AS VARCHAR), '|42')), 1, 8))
        AS BIGINT) % 100 < 20 THEN 'calib' ELSE 'fit' END AS split
    FROM orders WHERE epoch_us(o_orderdate) >= {CUTOFF_SQL}
      OR o_custkey NOT IN (SELECT o_custkey FROM late)""",
)
def time_user_split(spark: SparkSession, folder: str) -> DataFrame:
    orders = b.load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return splits.time_user_split(orders, "o_custkey", "o_orderdate").drop("o_orderdate")


@query("beta_calibration")
def beta_calibration(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of held-out rows before and after a calibration fitted on the other half."""
    rows = b.scored(spark, folder)
    calib = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    map_ = training.fit_beta_calibration(rows.where(calib), "score", "label")
    mapped = rows.where(~calib).withColumn("calibrated", training.calibrate(F.col("score"), map_))
    result = None
    for name in ("score", "calibrated"):
        ece = evaluate.expected_calibration_error(mapped, name, "label").scalar()
        auc = evaluate.area_under_roc(mapped, name, "label").scalar()
        row = evaluate.brier_score(mapped, name, "label").select(
            F.lit(name).alias("scores"), "brier", ece.alias("ece"), auc.alias("auc")
        )
        result = row if result is None else result.unionByName(row)
    return result


@query("tune_grid")
def tune_grid(spark: SparkSession, folder: str) -> DataFrame:
    """Grid points of 20 rounds over five out-of-time folds of the orders."""
    path = new_folder(spark, "folds")
    priority = F.substring("o_orderpriority", 1, 1).cast("int")
    folded_orders(spark, folder).select(
        "o_totalprice",
        priority.cast("double").alias("priority"),
        sc.flag(F.col("o_orderstatus") == "F").alias("label"),
        "fold",
    ).write.parquet(path)
    results = training.tune_grid(
        spark.read.parquet(path),
        ["o_totalprice", "priority"],
        "label",
        {"maxDepth": [3, 5], "maxIter": [20]},
    )
    return training.grid_frame(spark, results)


@query(
    "drop_id_columns",
    with_ctes(
        f"SELECT {', '.join(b.FEATURES)}, species FROM features",
        "features",
    ),
)
def drop_id_columns(spark: SparkSession, folder: str) -> DataFrame:
    return splits.drop_id_columns(b.canonical(spark, folder))
