"""Metric edge cases and identities."""

import random

import pytest
from pyspark.sql import functions as F

from scoreloom.functions.numeric import safe_score, threshold
from scoreloom.operators import metrics


def predictions(spark, groups):
    data = [(g, int(t), float(s), int(s >= 0.5)) for g, pairs in groups.items() for t, s in pairs]
    return spark.createDataFrame(data, "g string, target int, score double, prediction int")


def brute_auc(pairs):
    pos, neg = [s for t, s in pairs if t], [s for t, s in pairs if not t]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(pairs):
    total, p = 0.0, sum(t for t, _ in pairs)
    for cut in {s for _, s in pairs}:
        here = [t for t, s in pairs if s >= cut]
        total += sum(t for t, s in pairs if s == cut) * sum(here) / len(here)
    return total / p


def test_against_brute_force(spark):
    rng = random.Random(5)
    groups = {f"g{i}": [(rng.random() < 0.3, round(rng.random(), 2)) for _ in range(200)] for i in range(3)}
    groups["ties"] = [(i % 2, 0.5) for i in range(10)]
    for r in metrics.metric_rows(predictions(spark, groups), ["g"]).collect():
        pairs = groups[r.g]
        assert r.ROC == pytest.approx(brute_auc(pairs), abs=1e-12)
        assert r.AP == pytest.approx(brute_ap(pairs), abs=1e-12)
        assert r.TP == sum(t and s >= 0.5 for t, s in pairs)
        assert r.TN + r.FP + r.FN + r.TP == len(pairs)
        assert r.Recall == pytest.approx(r.TP / (r.TP + r.FN))


def test_single_class_groups(spark):
    rows = {r.g: r for r in metrics.metric_rows(predictions(spark, {"neg": [(0, 0.1), (0, 0.9)], "pos": [(1, 0.7)]}), ["g"]).collect()}
    assert rows["neg"].ROC is None and rows["neg"].AP == 0.0 and rows["neg"].F1 == 0.0
    assert rows["pos"].ROC is None and rows["pos"].AP == 1.0 and rows["pos"].Specificity is None
    assert rows["neg"].BalancedAccuracy == 0.5 and rows["pos"].BalancedAccuracy == 1.0


def test_auc_ignores_monotone_transforms(spark):
    rng = random.Random(2)
    pairs = [(rng.random() < 0.4, rng.random()) for _ in range(300)]
    got = metrics.roc_auc(predictions(spark, {"x": pairs, "y": [(t, s**3) for t, s in pairs]}), ["g"]).collect()
    assert got[0].ROC == pytest.approx(got[1].ROC, abs=1e-12)


def test_curve_runs_from_origin_to_one(spark):
    points = metrics.roc_curve(predictions(spark, {"g": [(1, 0.9), (0, 0.4), (1, 0.4), (0, 0.1)]}), ["g"]).collect()
    got = sorted((p.fpr, p.tpr) for p in points)
    assert got == [(0.0, 0.0), (0.0, 0.5), (0.5, 1.0), (1.0, 1.0)]


def test_empty_input_gives_no_rows(spark):
    assert metrics.metric_rows(predictions(spark, {}), ["g"]).count() == 0


def test_score_rules(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,), (0.5,), (0.49,)], "s double")
    got = [tuple(r) for r in df.select(safe_score(F.col("s")).alias("s")).select("s", threshold(F.col("s"))).collect()]
    assert got == [(0.5, 1), (1.0, 1), (0.0, 0), (0.5, 1), (0.5, 1), (0.49, 0)]
