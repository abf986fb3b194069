"""Model evaluation as aggregations: accuracy, curves, thresholds, calibration error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import flag
from tidemark.operators.ordered import equal_depth, running_totals

# Ties go to the model with the smaller priority.
PRIORITY = {"random_forest": 0, "decision_tree": 1}


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.agg(F.avg(flag(F.col(label) == F.col(predicted))).alias("accuracy"))


def choose_best(metrics: DataFrame, model: str = "model", score: str = "accuracy") -> DataFrame:
    """The model with the highest accuracy; on a tie the random forest wins."""
    rank = F.coalesce(*[F.when(F.col(model) == n, p) for n, p in PRIORITY.items()], F.lit(99))
    return metrics.orderBy(F.desc(score), rank, model).limit(1)


def confusion_matrix(df: DataFrame, label: str, predicted: str, classes: list) -> DataFrame:
    """One row per true class, one column ``predicted_<class>`` per predicted class."""
    counted = df.groupBy(label).agg(
        *[F.count_if(F.col(predicted) == F.lit(c)).alias(f"predicted_{c}") for c in classes]
    )
    return counted.where(F.col(label).isNotNull())


def threshold_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score: true and false positives when everything at or above it is positive."""
    per_score = df.groupBy(F.col(score).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    return running_totals(
        equal_depth(per_score, [], "threshold"),
        [],
        [F.col("_piece")],
        [F.col("threshold")],
        {"tp": F.col("_pos"), "fp": F.col("_neg")},
        descending=True,
    ).drop("_pos", "_neg", "_piece")


def _total(df: DataFrame, label: str, value: int) -> Column:
    return df.agg(F.count_if(F.col(label) == value)).scalar()


def roc_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """fpr and tpr per threshold (finite thresholds only)."""
    return threshold_counts(df, score, label).select(
        "threshold",
        F.try_divide(F.col("fp"), _total(df, label, 0)).alias("fpr"),
        F.try_divide(F.col("tp"), _total(df, label, 1)).alias("tpr"),
    )


def pr_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """precision, recall and number of predicted positives per threshold."""
    support = F.col("tp") + F.col("fp")
    return threshold_counts(df, score, label).select(
        "threshold",
        F.try_divide(F.col("tp"), support).alias("precision"),
        F.try_divide(F.col("tp"), _total(df, label, 1)).alias("recall"),
        support.alias("support"),
    )


def select_threshold(curve: DataFrame, target_precision: float, min_support: int) -> DataFrame:
    """The threshold with the most recall among those precise and supported enough.

    Of equal recalls the smallest threshold is taken; no candidate at all fails the job.
    """
    fits = (F.col("precision") >= target_precision) & (F.col("support") >= min_support)
    best = curve.where(fits).agg(
        F.max_by(
            F.struct("threshold", "precision", "recall", "support"),
            F.struct(F.col("recall"), -F.col("threshold")),
        ).alias("b")
    )
    refused = F.raise_error(F.lit("no threshold reaches the target precision")).cast("double")
    return best.select(
        F.coalesce("b.threshold", refused).alias("threshold"),
        "b.precision",
        "b.recall",
        "b.support",
    )


def area_under_roc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Rank form of the AUC: positives above negatives, ties count half."""
    per_score = df.groupBy(F.col(score).alias("_s")).agg(
        F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) == 0).alias("_neg")
    )
    below = running_totals(
        equal_depth(per_score, [], "_s"),
        [],
        [F.col("_piece")],
        [F.col("_s")],
        {"_neg_upto": F.col("_neg")},
    )
    wins = F.col("_pos") * (F.col("_neg_upto") - F.col("_neg") / 2)
    return below.agg(F.try_divide(F.sum(wins), F.sum("_pos") * F.sum("_neg")).alias("auc"))


def brier_score(df: DataFrame, score: str, label: str) -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))


def reliability_bins(df: DataFrame, score: str, label: str, bins: int = 10) -> DataFrame:
    """Mean score and observed rate per equal-width bin."""
    which = F.least(F.lit(bins - 1), F.floor(F.col(score) * bins)).cast("bigint")
    return df.groupBy(which.alias("bin")).agg(
        F.count("*").alias("rows"),
        F.avg(score).alias("mean_score"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"),
    )


def expected_calibration_error(
    df: DataFrame, score: str, label: str, bins: int = 10
) -> DataFrame:
    gap = F.abs(F.col("mean_score") - F.col("observed_rate"))
    return reliability_bins(df, score, label, bins).agg(
        F.try_divide(F.sum(F.col("rows") * gap), F.sum("rows")).alias("ece")
    )


def threshold_row(
    chosen: DataFrame, model_version: str, target_precision: float, selected_at: Column
) -> DataFrame:
    """Configuration row of a model version that passed the gate."""
    return chosen.select(
        F.lit(model_version).alias("model_version"),
        "threshold",
        F.lit(target_precision).alias("target_precision"),
        F.col("precision").alias("precision_on_test"),
        F.col("recall").alias("recall_on_test"),
        F.col("support").alias("calib_positives"),
        selected_at.alias("selected_at"),
        F.lit(True).alias("is_active"),
    )


def active_thresholds(config: DataFrame) -> DataFrame:
    """Newest active row per model version."""
    newest = Window.partitionBy("model_version").orderBy(F.desc("selected_at"))
    return (
        config.where("is_active")
        .withColumn("_r", F.row_number().over(newest))
        .where("_r = 1")
        .drop("_r")
    )
