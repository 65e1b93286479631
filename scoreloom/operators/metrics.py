"""Exact classification metrics for many experiments in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.operators.rank import running_totals

METRICS: tuple[str, ...] = (
    "ROC", "AP", "F1", "Accuracy", "BalancedAccuracy", "Recall", "Specificity", "Precision", "TN", "FP", "FN", "TP",
)


def _count(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def confusion_counts(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """TN, FP, FN, TP per experiment, classes fixed to 0 and 1."""
    y, p = F.col("target"), F.col("prediction")
    return predictions.groupBy(*keys).agg(
        _count((y == 0) & (p == 0)).alias("TN"),
        _count((y == 0) & (p == 1)).alias("FP"),
        _count((y == 1) & (p == 0)).alias("FN"),
        _count((y == 1) & (p == 1)).alias("TP"),
    )


def threshold_metrics(counts: DataFrame) -> DataFrame:
    """Rates from TN, FP, FN, TP. Undefined specificity is null, other undefined rates are 0."""
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("TN", "FP", "FN", "TP"))

    def rate(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    recall, precision = rate(tp, tp + fn), rate(tp, tp + fp)
    specificity = F.try_divide(tn, tn + fp)
    seen = F.when(tp + fn > 0, recall)
    return (
        counts.withColumn("Accuracy", rate(tp + tn, tp + tn + fp + fn))
        .withColumn("Recall", recall)
        .withColumn("Precision", precision)
        .withColumn("F1", rate(2 * tp, 2 * tp + fp + fn))
        .withColumn("Specificity", specificity)
        .withColumn(
            "BalancedAccuracy",
            F.coalesce((seen + specificity) / 2, seen, specificity),
        )
    )


def score_ladder(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per experiment and distinct score: rows, positives and their running totals by falling score.

    Predictions are aggregated to distinct scores before anything is ordered,
    so ties are exact and the ordered part shrinks with them.
    """
    hit = F.col("prediction") == 1
    steps = predictions.groupBy(*keys, "score").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("target").cast("bigint").alias("pos"),
        _count(hit).cast("bigint").alias("called"),
        _count(hit & (F.col("target") == 1)).cast("bigint").alias("called_pos"),
    )
    return running_totals(steps, keys, "score", ["rows", "pos"])


def _ranking(keys: Sequence[str]) -> list[Column]:
    rows, pos, cum_pos, cum_rows = (F.col(c).cast("double") for c in ("rows", "pos", "cum_pos", "cum_rows"))
    p, n = F.sum(pos), F.sum(rows - pos)
    return [
        F.try_divide(F.sum((rows - pos) * (cum_pos - pos / 2)), p * n).alias("ROC"),
        F.coalesce(F.try_divide(F.sum(pos * cum_pos / cum_rows), p), F.lit(0.0)).alias("AP"),
    ]


def roc_auc(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Area under the ROC curve, ties counted half; null when a class is absent."""
    return score_ladder(predictions, keys).groupBy(*keys).agg(_ranking(keys)[0])


def average_precision(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Step-wise average precision over distinct scores; 0 without positives."""
    return score_ladder(predictions, keys).groupBy(*keys).agg(_ranking(keys)[1])


def roc_curve(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score; the start point (0, 0) has no threshold."""
    ladder = score_ladder(predictions, keys)
    totals = ladder.groupBy(*keys).agg(
        F.sum("pos").cast("double").alias("_p"), F.sum(F.col("rows") - F.col("pos")).cast("double").alias("_n")
    )
    points = ladder.join(totals, list(keys)).select(
        *keys,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_rows") - F.col("cum_pos"), F.col("_n")).alias("fpr"),
        F.try_divide(F.col("cum_pos"), F.col("_p")).alias("tpr"),
    )
    start = totals.select(
        *keys, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def metric_rows(predictions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row of all metrics per experiment, for any number of experiments at once."""
    keys = list(keys)
    called, called_pos, rows, pos = (F.col(c) for c in ("called", "called_pos", "rows", "pos"))
    counted = (
        score_ladder(predictions, keys)
        .groupBy(*keys)
        .agg(
            *_ranking(keys),
            F.sum(rows - pos - called + called_pos).alias("TN"),
            F.sum(called - called_pos).alias("FP"),
            F.sum(pos - called_pos).alias("FN"),
            F.sum(called_pos).alias("TP"),
        )
    )
    return threshold_metrics(counted).select(*keys, *METRICS)
