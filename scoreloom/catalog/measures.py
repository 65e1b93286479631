"""Exact metrics over whole line items."""

from __future__ import annotations

from scoreloom.catalog import common as C
from scoreloom.catalog import sql as S
from scoreloom.catalog.cleaning import _LINE_METRICS
from scoreloom.catalog.registry import query
from scoreloom.operators import metrics

_KEYS = ["dataset", "experiment"]
_ALL = ("quantity", "discount", "tax", "price")
_FULL = _LINE_METRICS + ",\n" + S.ladder("pred", "dataset, experiment") + ",\n" + S.metric_block("m", "ladder", "dataset, experiment") + "\n"


@query("confusion_counts", _FULL + "SELECT dataset, experiment, TN, FP, FN, TP FROM m")
def confusion_counts(spark, sf):
    return metrics.confusion_counts(C.line_scores(spark, sf, *_ALL), _KEYS)


_RATES = ("Accuracy", "BalancedAccuracy", "Recall", "Specificity", "Precision", "F1")


@query("threshold_metrics", _FULL + f"SELECT dataset, experiment, TN, FP, FN, TP, {S.rounded(*_RATES)} FROM m")
def threshold_metrics(spark, sf):
    counts = metrics.confusion_counts(C.line_scores(spark, sf, *_ALL), _KEYS)
    return C.rounded(metrics.threshold_metrics(counts), *_RATES)


@query("roc_auc", _FULL + f"SELECT dataset, experiment, {S.rounded('ROC')} FROM m")
def roc_auc(spark, sf):
    return C.rounded(metrics.roc_auc(C.line_scores(spark, sf, *_ALL), _KEYS), "ROC")


@query("average_precision", _FULL + f"SELECT dataset, experiment, {S.rounded('AP')} FROM m")
def average_precision(spark, sf):
    return C.rounded(metrics.average_precision(C.line_scores(spark, sf, *_ALL), _KEYS), "AP")


@query(
    "roc_curve",
    _LINE_METRICS + ",\n" + S.ladder("pred", "dataset, experiment")
    + "\nSELECT dataset, experiment, round(score, 8) AS threshold, round((cum_rows - cum_pos) / n, 6) AS fpr, round(cum_pos / p, 6) AS tpr FROM ("
    "SELECT *, sum(pos) OVER w AS p, sum(rows - pos) OVER w AS n FROM ladder WINDOW w AS (PARTITION BY dataset, experiment))"
    " UNION ALL SELECT DISTINCT dataset, experiment, NULL::DOUBLE, 0.0, 0.0 FROM ladder",
)
def roc_curve(spark, sf):
    points = metrics.roc_curve(C.line_scores(spark, sf, *_ALL), _KEYS)
    return C.rounded(C.rounded(points, "threshold", digits=8), "fpr", "tpr")


@query("metric_row", _FULL + f"SELECT dataset, experiment, {S.rounded('ROC', 'AP', *_RATES)}, TN, FP, FN, TP FROM m")
def metric_row(spark, sf):
    rows = metrics.metric_rows(C.line_scores(spark, sf, *_ALL), _KEYS)
    return C.rounded(rows, "ROC", "AP", *_RATES)
