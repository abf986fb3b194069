"""Training, comparing, saving and applying MLlib classifiers."""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.evaluate import accuracy
from tidemark.session import new_folder

CLIP = 1e-6  # fixed value: scores are kept this far from 0 and 1 before taking logs
DECISION_TREE, RANDOM_FOREST = "decision_tree", "random_forest"

# Fixed values, as MLlib has them: bins of a feature in a tree, values that their borders come from.
BINS, BIN_VALUES = 32, 10_000
_BIN, _WEIGHT = "_bin_", "_rows"


def _fit(df: DataFrame, features: Sequence[str], estimator) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    return Pipeline(stages=[assembler, estimator]).fit(df)


def _borders(values: Sequence[float]) -> list[float]:
    """Borders between about equally many of the sorted ``values``, placed as MLlib's trees do."""
    counted = list(Counter(values).items())
    pairs = list(itertools.pairwise(counted))
    if len(counted) <= BINS:
        return [(a + b) / 2 for (a, _), (b, _) in pairs]
    stride = len(values) / BINS
    target, upto, borders = stride, 0, []
    for (a, n), (b, m) in pairs:
        upto += n
        if abs(upto - target) < abs(upto + m - target):
            borders.append((a + b) / 2)
            target += stride
    return borders


def binned(df: DataFrame, features: Sequence[str]) -> Bucketizer:
    """The bins in which trees see the features, as numbers in their order.

    A tree only asks on which side of a border a value lies, so rows that share all bins and the
    label are one weighted row to it (``cells``).  The borders come from evenly spaced values among
    all rows, found by a mergeable sketch; of at most ``BIN_VALUES`` rows these are all values.
    """
    values = df.select(*[F.col(c).cast("double").alias(c) for c in features])
    wanted = min(max(values.count(), 1), BIN_VALUES)
    evenly = [(i + 0.5) / wanted for i in range(wanted)]
    splits = []
    for found in values.approxQuantile(list(features), evenly, 0.1 / BIN_VALUES):
        known = found or [0.0]
        # A bin starts right above its border: values on a border go left.
        above = [math.nextafter(v, math.inf) for v in _borders(known) or known[-1:]]
        splits.append([-math.inf, *dict.fromkeys(above), math.inf])
    names = [f"{_BIN}{c}" for c in features]
    return Bucketizer(splitsArray=splits, inputCols=list(features), outputCols=names)


def cells(bins: Bucketizer, df: DataFrame, label: str) -> DataFrame:
    """The rows that share all bins and the label, counted; bins have an order, they are no classes."""
    numeric = {"ml_attr": {"type": "numeric"}}
    keys = [F.col(c).alias(c, metadata=numeric) for c in bins.getOutputCols()]
    return bins.transform(df).groupBy(*keys, label).agg(
        F.count("*").cast("double").alias(_WEIGHT)
    )


def _fit_binned(df: DataFrame, features: Sequence[str], label: str, tree) -> PipelineModel:
    bins = binned(df, features)
    fitted = _fit(cells(bins, df, label), bins.getOutputCols(), tree.setWeightCol(_WEIGHT))
    return PipelineModel([bins, *fitted.stages])


def fit_decision_tree(
    df: DataFrame, features: Sequence[str], label: str, seed: int = 42, depth: int = 30
) -> PipelineModel:
    # Trees grow without a limit by default; 30 is the deepest that MLlib supports.
    tree = DecisionTreeClassifier(labelCol=label, maxDepth=depth, seed=seed)
    return _fit_binned(df, features, label, tree)


def fit_random_forest(
    df: DataFrame, features: Sequence[str], label: str, seed: int = 42, trees: int = 100
) -> PipelineModel:
    forest = RandomForestClassifier(
        labelCol=label, numTrees=trees, featureSubsetStrategy="sqrt", seed=seed
    )
    return _fit(df, features, forest)


def fit_boosted(
    df: DataFrame, features: str, label: str, rounds: int = 20, depth: int = 5, seed: int = 42
) -> PipelineModel:
    """Boosted trees for a 0/1 label on a vector column."""
    boosted = GBTClassifier(
        featuresCol=features, labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed
    )
    return Pipeline(stages=[boosted]).fit(df)


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds the integer class and the probabilities in class order."""
    return (
        model.transform(df)
        .withColumn("class_", F.col("prediction").cast("bigint"))
        .withColumn("class_probabilities", vector_to_array("probability"))
        .drop("features", "rawPrediction", "probability", "prediction")
        .drop(*[f"{_BIN}{c}" for c in df.columns])
    )


def model_scores(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Scores in the shape the batch scorer gives, computed inside the JVM."""
    return predict(model, df).select(
        *df.columns,
        "class_",
        "class_probabilities",
        F.lit(None).cast("double").alias("processing_time"),
        F.lit(None).cast("string").alias("score_error"),
        F.lit(None).cast("string").alias("score_message"),
        F.lit(0).cast("bigint").alias("score_retries"),
        F.lit(None).cast("string").alias("score_group"),
    )


def model_accuracy(model: PipelineModel, df: DataFrame, label: str) -> DataFrame:
    return accuracy(predict(model, df), label, "class_")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def check_feature_names(model: PipelineModel, expected: Sequence[str]) -> list[str]:
    """The model's inputs; fails unless they are exactly the contract's features, in order."""
    names = next(s for s in model.stages if isinstance(s, (Bucketizer, VectorAssembler))).getInputCols()
    if list(names) != list(expected):
        raise ValueError(f"model expects {names}, the contract has {list(expected)}")
    return list(names)


def batch_inference(
    model: PipelineModel,
    rows: DataFrame,
    model_path: str,
    as_of: Column,
) -> DataFrame:
    """Feature rows plus prediction, prediction time and model path."""
    kept = rows.columns
    return predict(model, rows).select(
        *kept,
        F.col("class_").alias("prediction"),
        as_of.alias("prediction_timestamp"),
        F.lit(model_path).alias("model_path"),
    )


def vectors(df: DataFrame, array_column: str, name: str = "features") -> DataFrame:
    return df.withColumn(name, array_to_vector(F.col(array_column).cast("array<double>")))


def beta_inputs(score: Column) -> list[Column]:
    """The two regressors of beta calibration: ln s and -ln(1 - s)."""
    clipped = F.greatest(F.lit(CLIP), F.least(F.lit(1 - CLIP), score))
    return [F.ln(clipped).alias("ln_s"), (-F.ln(1 - clipped)).alias("ln_1s")]


def fit_beta_calibration(df: DataFrame, score: str, label: str) -> dict[str, float]:
    """Coefficients a, b, c of p = 1 / (1 + exp(-(a ln s - b ln(1 - s) + c))).

    Starts with both terms and leaves out, one at a time, a term that would lower the
    probability of higher scores; without any, the probability is the share of positives.
    """
    inputs = df.select(F.col(label).cast("double").alias("y"), *beta_inputs(F.col(score)))
    used, weights = ["ln_s", "ln_1s"], {}
    while used:
        model = _fit(inputs, used, LogisticRegression(labelCol="y")).stages[-1]
        weights = dict(zip(used, model.coefficients.toArray().tolist()))
        falling = [term for term in used if weights[term] < 0]
        if not falling:
            return {
                "a": weights.get("ln_s", 0.0),
                "b": weights.get("ln_1s", 0.0),
                "c": float(model.intercept),
            }
        used.remove(falling[0])
    share = inputs.select(F.avg("y")).first()[0]
    share = min(max(share, 1e-6), 1 - 1e-6)
    return {"a": 0.0, "b": 0.0, "c": math.log(share / (1 - share))}


def calibrate(score: Column, coefficients: Mapping[str, float]) -> Column:
    ln_s, ln_1s = beta_inputs(score)
    z = ln_s * coefficients["a"] + ln_1s * coefficients["b"] + coefficients["c"]
    return 1 / (1 + F.exp(-z))


def tune_grid(
    folds: DataFrame,
    features: Sequence[str],
    label: str,
    grid: Mapping[str, Sequence],
    n_folds: int = 5,
    seed: int = 42,
    at_once: int = 5,
) -> list[dict]:
    """Mean average precision of every grid point over expanding out-of-time folds.

    ``folds`` carries ``fold`` 0..n: fold k validates on k and trains on all earlier rows.
    Each fit is a distributed job; ``at_once`` of them share the cluster.  The rows of a fold are
    counted once per cell of the training rows' bins; all points fit and validate on these cells.
    """
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, metricName="areaUnderPR", weightCol=_WEIGHT
    )
    points = [dict(zip(grid, point)) for point in itertools.product(*grid.values())]
    spark, path = folds.sparkSession, new_folder(folds.sparkSession, "cells")

    def counted(k: int) -> list[str]:
        parts = folds.where(F.col("fold") < k), folds.where(F.col("fold") == k)
        bins = binned(parts[0], features)
        for name, part in zip(("train", "test"), parts):
            cells(bins, part, label).write.parquet(f"{path}/{name}-{k}")
        return bins.getOutputCols()

    def score(fit: tuple[dict, int]) -> float:
        params, k = fit
        train, test = (spark.read.parquet(f"{path}/{name}-{k}") for name in ("train", "test"))
        tree = GBTClassifier(labelCol=label, seed=seed, weightCol=_WEIGHT, **params)
        return evaluator.evaluate(_fit(train, names[k - 1], tree).transform(test))

    with ThreadPoolExecutor(at_once) as pool:
        names = list(pool.map(counted, range(1, n_folds + 1)))
    with ThreadPoolExecutor(at_once) as pool:
        scores = list(pool.map(score, itertools.product(points, range(1, n_folds + 1))))
    results = []
    for i, params in enumerate(points):
        own = scores[i * n_folds : (i + 1) * n_folds]
        results.append({**params, "average_precision": sum(own) / n_folds})
    return results


def grid_frame(spark: SparkSession, results: list[dict]) -> DataFrame:
    return spark.createDataFrame(results).orderBy(F.desc("average_precision"))
