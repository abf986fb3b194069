"""Retries, short replies, evaluation gates, calibration."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from tidemark.operators import evaluate, scoring, training
from tidemark.streaming.batching import numbered

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests


class Flaky:
    """Fails a number of times per task before it answers."""

    def __init__(self, failures, error):
        self.failures, self.error = failures, error

    def __call__(self, matrix):
        if self.failures:
            self.failures -= 1
            raise self.error("trouble")
        return [1] * len(matrix), [[0.2, 0.8]] * len(matrix)


def nothing(seconds):
    return None


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(0, 120, 1, 1).select(
        F.col("id").cast("string").alias("entity_id"), F.col("id").cast("double").alias("x")
    )


def outcome(df):
    got = df.groupBy("score_error", "score_retries").count().collect()
    return {(r.score_error, r.score_retries): r["count"] for r in got}


def test_transport_errors_are_retried(rows):
    flaky = scoring.score_rows(rows, ["x"], Flaky(2, TimeoutError), wait=nothing)
    assert outcome(flaky) == {(None, 2): 50, (None, 0): 70}


def test_failed_group_gives_one_letter_per_row(rows):
    down = scoring.score_rows(rows, ["x"], Flaky(10**6, ConnectionError), wait=nothing)
    assert outcome(down) == {("connection", 3): 120}
    assert scoring.score_failures(down, F.current_timestamp()).count() == 120


def test_other_errors_are_not_retried(rows):
    broken = scoring.score_rows(rows, ["x"], Flaky(10**6, ValueError), wait=nothing)
    assert outcome(broken) == {("connection", 0): 120}


def test_short_reply(rows):
    def short(matrix):
        return [0] * (len(matrix) - 1), [[1.0]] * (len(matrix) - 1)

    assert outcome(scoring.score_rows(rows, ["x"], short)) == {(None, 0): 117, ("short_reply", 0): 3}


def test_groups_hold_at_most_the_batch_size(rows):
    def sizes(matrix):
        return [len(matrix)] * len(matrix), [[]] * len(matrix)

    got = scoring.score_rows(rows, ["x"], sizes, batch_rows=50).groupBy("class_").count().collect()
    assert {(r.class_, r["count"]) for r in got} == {(50, 100), (20, 20)}


def test_tie_goes_to_the_forest(spark):
    metrics = spark.createDataFrame(
        [("decision_tree", 0.9), ("random_forest", 0.9)], "model string, accuracy double"
    )
    assert evaluate.choose_best(metrics).first().model == "random_forest"


def test_unreachable_precision_fails(spark):
    df = spark.createDataFrame([(0.1, 0), (0.9, 1), (0.8, 0)], "s double, y int")
    curve = evaluate.pr_curve(df, "s", "y")
    assert evaluate.select_threshold(curve, 0.9, 1).first().threshold == 0.9
    with pytest.raises(Exception, match="target precision"):
        evaluate.select_threshold(curve, 0.9, 2).collect()


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(0.1, 0), (0.5, 0), (0.5, 1), (0.9, 1)], "s double, y int")
    assert evaluate.area_under_roc(df, "s", "y").first().auc == pytest.approx(0.875)


def test_calibration_keeps_the_ranking(spark):
    rows = [(i / 200, int(i % 7 < i / 40)) for i in range(1, 200)]
    df = spark.createDataFrame(rows, "s double, y int")
    shape = training.fit_beta_calibration(df, "s", "y")
    assert shape["a"] >= 0 and shape["b"] >= 0 and max(shape["a"], shape["b"]) > 0
    mapped = df.withColumn("p", training.calibrate(F.col("s"), shape))
    before = evaluate.area_under_roc(df, "s", "y").first().auc
    assert evaluate.area_under_roc(mapped, "p", "y").first().auc == pytest.approx(before, abs=1e-6)


def test_model_features_must_match(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.0), (2.0, 1.0, 1.0)], "a double, b double, y double")
    model = training.fit_decision_tree(df, ["a", "b"], "y")
    training.check_feature_names(model, ["a", "b"])
    with pytest.raises(ValueError):
        training.check_feature_names(model, ["b", "a"])


def test_groups_are_consecutive_messages(spark):
    """Numbers that are null or come twice take a place each; the scorer gets whole groups only."""
    ids = [*range(0, 30_000, 2), *[40] * 200, *[None] * 9]
    rows = spark.createDataFrame([(n, float(i)) for i, n in enumerate(ids)], "n long, x double")
    ranked = numbered(rows.repartition(3), "n").withColumn("batch", F.floor((F.col("rank") - 1) / 7))
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, len(ids) + 1))
    assert {r["rank"] for r in ranked.where("n is null").collect()} == set(range(len(ids) - 8, len(ids) + 1))
    one = ranked.coalesce(1).sortWithinPartitions("batch", "rank")  # more than an Arrow batch
    scored = scoring.score_rows(one, ["x"], scoring.ThresholdRule(0, 1.0, 2.0), batch_rows=7, group="batch")
    calls = scored.groupBy("score_group").agg(F.count("*").alias("n"), F.count_distinct("batch").alias("b")).collect()
    assert len(calls) == -(-len(ids) // 7) and all(c.b == 1 and c.n <= 7 for c in calls)
    assert sum(c.n for c in calls) == len(ids)


def test_trees_fit_cells_of_rows(spark):
    """Trees see the rows' bins only: counted cells give the tree that the rows give."""
    rows = [((i * 37 % 2003) / 7, float(i % 3), float((i * i + i // 50) % 3)) for i in range(4000)]
    df = spark.createDataFrame(rows, "a double, b double, y double")
    bins = training.binned(df, ["a", "b"])
    assert training.cells(bins, df, "y").count() <= 32 * 3 * 3 < df.count()
    tree = DecisionTreeClassifier(labelCol="y", maxDepth=6, seed=42)
    plain = training.predict(training._fit(df, ["a", "b"], tree), df).collect()
    model = training.fit_decision_tree(df, ["a", "b"], "y", depth=6)
    assert training.predict(model, df).collect() == plain


def test_grid_points_share_the_counted_cells(spark):
    rows = [(i % 4, float(i * 31 % 997), float(i % 5), float(i % 7 < 2 + i % 2)) for i in range(3000)]
    folds = spark.createDataFrame(rows, "fold long, a double, b double, y double")
    got = training.tune_grid(folds, ["a", "b"], "y", {"maxDepth": [2], "maxIter": [3]}, n_folds=1)
    train, test = folds.where("fold < 1"), folds.where("fold = 1")
    model = training._fit(train, ["a", "b"], GBTClassifier(labelCol="y", seed=42, maxDepth=2, maxIter=3))
    measure = BinaryClassificationEvaluator(labelCol="y", metricName="areaUnderPR")
    assert got[0]["average_precision"] == pytest.approx(measure.evaluate(model.transform(test)))
