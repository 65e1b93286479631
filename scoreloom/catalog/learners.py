"""Trained models: rows-only checks, small settings except `gbt`; the defaults live in the library."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.catalog import common as C
from scoreloom.catalog.registry import query
from scoreloom.operators import ensemble, metrics, models, report, search
from scoreloom.plans import steps

DATASETS = ("quality", "toxic")
FAMILIES = C.family("keys", "desc")
SMALL = {"trees": 16, "depth": 5}
ROUNDS = {"rounds": 8}

# Settings that keep a check short; None in a map entry means the library default.
CHECK_PARAMS = {
    "RandomForest": SMALL,
    "ExtraTrees": {"trees": 16, "depth": 5, "groups": 2},
    "GradientBoosting": ROUNDS,
    "HistGradientBoosting": {"rounds": 8, "depth": 4},
    "XGBoost": {"rounds": 8},
    "CatBoost": {"rounds": 8},
    "LogisticRegression": {"max_iter": 50},
    "LinearSVM": {"max_iter": 15},
    "RBF_SVM": {"max_iter": 15, "size": 64},
}


SPACE = {**search.FOREST_SPACE, "n_estimators": (SMALL["trees"],), "max_depth": (SMALL["depth"],)}


def _rows(spark, sf, families=FAMILIES):
    return steps.prepare(C.labelled(spark, sf, *[f.name for f in families]), families)


def _ready(spark, sf, families=FAMILIES):
    return steps.assembled(_rows(spark, sf, families), families)


def _one(name, families=FAMILIES, params=CHECK_PARAMS):
    def run(spark, sf):
        table, status = steps.model_comparison(_ready(spark, sf, families), DATASETS, [name], params)
        failed = [s for s in status if s[1] != "OK"]
        if failed:
            raise RuntimeError(str(failed))
        return table

    return run


def _each(make):
    """Rows of both datasets."""
    return report.union_results([make(d).withColumn("Dataset", F.lit(d)) for d in DATASETS])


for _key, _name in (
    ("rf_baseline", "RandomForest"),
    ("extra_trees", "ExtraTrees"),
    ("gbt_hist", "HistGradientBoosting"),
    ("logreg", "LogisticRegression"),
    ("linear_svm_calibrated", "LinearSVM"),
    ("rbf_svm_rff", "RBF_SVM"),
    ("decision_tree", "DecisionTree"),
    ("gbt_subsampled", "XGBoost"),
    ("gbt_depth4", "CatBoost"),
):
    query(_key)(_one(_name))

# The whole job: all rounds of the library default, all four families.
query("gbt")(_one("GradientBoosting", C.FAMILIES, {}))


@query("model_comparison")
def model_comparison(spark, sf):
    return steps.model_comparison(_ready(spark, sf), DATASETS, params=CHECK_PARAMS)[0]


@query("feature_ablation")
def feature_ablation(spark, sf):
    """A forest per feature set, all four families."""
    rows = steps.prepare(C.labelled(spark, sf, *[f.name for f in C.FAMILIES]), C.FAMILIES)
    return steps.ablation(rows, C.FAMILIES, DATASETS, params=SMALL)


@query("rf_importance")
def rf_importance(spark, sf):
    ready = _ready(spark, sf)
    names = [n for f in FAMILIES for n in f.names]
    rows = []
    for d in DATASETS:
        model = models.fit("RandomForest", steps.part(ready, d, "train"), SMALL).model
        rows += [(d, i, n, float(v)) for i, (n, v) in enumerate(zip(names, model.featureImportances.toArray()))]
    return spark.createDataFrame(rows, "dataset string, idx int, feature string, score double")


@query("selection_grid")
def selection_grid(spark, sf):
    return steps.selection_grid(
        _rows(spark, sf), FAMILIES, DATASETS, ["ANOVA", "Chi2", "MutualInfo", "RF_importance"], [10, 30], SMALL
    )


@query("resampling_sweep")
def resampling_sweep(spark, sf):
    """A forest per class-resampling scenario."""
    return steps.resampling(_ready(spark, sf), DATASETS, params=SMALL)


@query("cv_search")
def cv_search(spark, sf):
    ready = _ready(spark, sf)
    sampled = search.parameter_rows(search.sample_params(spark, 3, space=SPACE))
    candidates = [search.forest_params(r) for r in sampled]
    return _each(lambda d: search.cross_validate(steps.part(ready, d, "train"), candidates, ratio=1.0, method="oversampling"))


@query("candidate_test_eval")
def candidate_test_eval(spark, sf):
    ready = _ready(spark, sf)
    return _each(lambda d: steps.tuning(ready, d, 1.0, "oversampling", n=3, space=SPACE))


def _stacked(spark, sf, meta, params, passthrough, gatekeeper):
    ready = _ready(spark, sf)
    members = {n: (m, CHECK_PARAMS[m]) for n, (m, _) in steps.strong_members(gatekeeper=gatekeeper).items()}

    def stacked(d):
        scored = ensemble.stack(steps.part(ready, d, "train"), steps.part(ready, d, "test"), members, meta, params, passthrough)
        return scored.withColumn("dataset", F.lit(d))

    return metrics.metric_rows(report.union_results([stacked(d) for d in DATASETS]), ["dataset"])


@query("stacking_lr")
def stacking_lr(spark, sf):
    return _stacked(spark, sf, "LogisticRegression", {"weights": None, "standard": False}, False, True)


@query("stacking_rf_passthrough")
def stacking_rf_passthrough(spark, sf):
    return _stacked(spark, sf, "RandomForest", SMALL, True, False)


@query("multiview_linear")
def multiview_linear(spark, sf):
    views = ["keys", "desc", "keys_desc"]
    valid, tested = steps.view_scores(_rows(spark, sf), FAMILIES, DATASETS, views, params=SMALL)

    def combined(d):
        scored, weights = ensemble.multiview_linear(valid.filter(F.col("dataset") == d), tested.filter(F.col("dataset") == d), views)
        return scored.withColumns({"dataset": F.lit(d), "Weights": F.lit(str(weights))})

    return metrics.metric_rows(report.union_results([combined(d) for d in DATASETS]), ["dataset", "Weights"])


@query(
    "sweep_status",
    """
    SELECT candidate, CASE WHEN candidate = 1 THEN 'FAILED' ELSE 'OK' END AS "Status", candidate <> 1 AS measured,
           CASE WHEN candidate = 1 THEN 3 ELSE 1 END <= 2 AS ranked_before_failed
    FROM (SELECT unnest([0, 1, 2]) AS candidate) WHERE (SELECT count(*) FROM labels) > 0
    """,
)
def sweep_status(spark, sf):
    """Three settings of which one cannot be fitted: it has a row, no metrics and the last rank."""
    ready = _ready(spark, sf)
    train, test = steps.part(ready, "quality", "train"), steps.part(ready, "quality", "test")
    candidates = [SMALL, {**SMALL, "max_features": "no such rule"}, {**SMALL, "criterion": "entropy"}]
    table = search.evaluate_candidates(train, test, candidates)
    return table.select(
        "candidate", "Status", F.col("Test_ROC").isNotNull().alias("measured"), (F.col("CandidateRank") <= 2).alias("ranked_before_failed")
    )
