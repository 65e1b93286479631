"""Comparison tables: precedence, ties, undefined gains, missing rows."""

import pytest

from scoreloom.operators import rank, report


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_existing_column_wins_even_when_null(spark):
    df = table(spark, [("a", None, "RandomForest", "Gatekeeper RF", 0.5)], "Dataset string, ModelName string, ModelType string, Comparison string, ROC double")
    row = report.normalize(df, "05_model_search", "f", ["a"]).first()
    assert row.ModelName is None and row.ModelFamily == "RandomForest" and row.CandidateLabel == "Gatekeeper RF"
    assert row.SamplingScenario == "none" and row.AP is None and row.StepOrder == 5


def test_labels(spark):
    schema = "Dataset string, ModelName string, Comparison string, ROC double"
    df = table(spark, [("a", "Stack", "Best advanced ensemble", 0.5), ("a", "RF", "Gatekeeper", 0.4), ("a", "RF", "", 0.3), ("x", "RF", "", 0.2)], schema)
    got = [r.CandidateLabel for r in report.normalize(df, "08_advanced_ensemble", "f", ["a"]).orderBy("ROC").collect()]
    assert got == ["RF", "Gatekeeper: RF", "Best advanced ensemble: Stack"]
    assert report.normalize(df.drop("ROC"), "07_tuning", "f", ["a"]) is None


def test_first_in_input_wins_a_tie_and_nulls_come_last(spark):
    df = table(spark, [("a", 1, 0.9), ("a", 2, 0.9), ("b", 3, None), ("b", 4, 0.1)], "Dataset string, n int, ROC double")
    got = {r.Dataset: r.n for r in rank.best_per_group(df, ["Dataset"], "ROC", "n").collect()}
    assert got == {"a": 1, "b": 4}


def test_gain_is_null_when_previous_is_zero(spark):
    schema = "Dataset string, ROC double, AP double, F1 double"
    now = table(spark, [("a", 0.9, 0.5, 0.5), ("lonely", 1.0, 1.0, 1.0)], schema)
    before = table(spark, [("a", 0.6, 0.0, 0.25), ("a", 0.5, 0.9, 0.9)], schema)
    rows = report.gain(now, before, "new", "old").orderBy("Dataset").collect()
    assert [r.Dataset for r in rows] == ["a", "lonely"]
    assert rows[1].Previous_ROC is None and rows[1].ROC_Delta is None and rows[1]["ROC_Gain_%"] is None
    assert rows[0]["ROC_Gain_%"] == pytest.approx(50.0)
    assert rows[0]["AP_Gain_%"] is None and rows[0].AP_Delta == 0.5
    assert rows[0]["F1_Gain_%"] == pytest.approx(100.0)


def chain(spark):
    # A known progression: selected ROC per step and the deltas between steps.
    schema = "Dataset string, Step string, StepOrder int, CandidateLabel string, ModelName string, ModelFamily string, FeatureStrategy string, SamplingScenario string, ROC double, AP double, F1 double, BalancedAccuracy double, SourceFile string"
    row = lambda step, order, label, roc, strategy="desc": ("d", step, order, label, "RF", "RF", strategy, "none", roc, roc, roc, roc, "f")
    return table(
        spark,
        [
            row("03_feature_ablation", 3, "Best feature set", 0.889),
            row("03_feature_ablation", 3, "Reference", 0.856, "morgan"),
            row("05_model_search", 5, "Gatekeeper RF", 0.889),
            row("07_tuning", 7, "Tuned RF", 0.893),
            row("08_advanced_ensemble", 8, "Best", 0.8902),
        ],
        schema,
    )


def test_progression_and_final_is_the_last_step(spark):
    candidates = chain(spark)
    baseline = report.baseline_lift(candidates)
    selected = report.progression(baseline.unionByName(candidates))
    steps = [(r.StepOrder, r.ROC) for r in selected.orderBy("StepOrder").collect()]
    assert steps == [(2, 0.856), (3, 0.889), (5, 0.889), (7, 0.893), (8, 0.8902)]
    deltas = [r.ROC_Delta_vs_Previous_Selected for r in report.progression_deltas(selected).orderBy("StepOrder").collect()]
    assert deltas[0] is None and deltas[1:] == pytest.approx([0.033, 0.0, 0.004, -0.0028])
    final = report.final_candidate(selected).first()
    assert final.StepOrder == 8 and final.ROC == 0.8902
    both = report.baseline_vs_final(baseline, report.final_candidate(selected)).first()
    assert both["ROC_Gain_%"] == pytest.approx(100 * (0.8902 - 0.856) / 0.856)


def test_union_fills_missing_columns(spark):
    a = table(spark, [("a", 1)], "Dataset string, x int")
    b = table(spark, [("b", 2.0)], "Dataset string, y double")
    got = {r.Dataset: (r.x, r.y) for r in report.union_results([a, b]).collect()}
    assert got == {"a": (1, None), "b": (None, 2.0)}
