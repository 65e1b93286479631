"""Trained models on a small separable set: valid scores, better than chance, failures reported."""

import random
import shutil

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import functions as F

from scoreloom.operators import ensemble, metrics, models, search, split, stages
from scoreloom.session import stored
from scoreloom.sources import store

FAST = {
    "RandomForest": {"trees": 8, "depth": 4},
    "ExtraTrees": {"trees": 8, "depth": 4, "groups": 2},
    "GradientBoosting": {"rounds": 4},
    "HistGradientBoosting": {"rounds": 4},
    "XGBoost": {"rounds": 4},
    "CatBoost": {"rounds": 4},
    "LinearSVM": {"max_iter": 10},
    "RBF_SVM": {"max_iter": 10, "size": 32},
}


@pytest.fixture(scope="module")
def parts(spark):
    rng = random.Random(4)
    data = [("d", i, int(i % 3 == 0), [rng.gauss(2.0 * (i % 3 == 0), 1.0), rng.gauss(0, 1), 5.0]) for i in range(240)]
    rows = spark.createDataFrame(data, "dataset string, row_id long, target int, v array<double>")
    rows = rows.withColumn("features", array_to_vector("v")).drop("v")
    marked = stored(split.kfold(split.stratified(rows), dataset=("dataset", "split")))
    return marked.filter("split = 'train'"), marked.filter("split = 'test'")


@pytest.mark.parametrize("name", list(models.PROFILES))
def test_model_beats_chance(parts, name):
    train, test = parts
    scored = models.fit_predict(name, train, test, FAST.get(name)).cache()
    assert scored.columns == list(models.SCORED)
    assert scored.count() == test.count()
    assert scored.filter("score < 0 or score > 1 or score is null or prediction not in (0, 1)").count() == 0
    row = metrics.metric_rows(scored.withColumn("g", F.lit(1)), ["g"]).first()
    assert row.ROC > 0.75


@pytest.mark.parametrize("name", list(models.PROFILES))
def test_a_saved_pipeline_scores_the_same(parts, name, tmp_path):
    """Reloaded with all that stands before and after the model; the scratch folders of the fit are not needed."""
    train, test = parts
    params = {**(FAST.get(name) or {}), **({"rounds": 2} if "rounds" in (FAST.get(name) or {}) else {})}
    scorer = models.fit(name, train, params)
    store.write_pipeline(scorer, str(tmp_path / name))
    before = {r.row_id: (r.score, r.prediction) for r in scorer(test).collect()}
    if name == "kNN":
        shutil.rmtree(scorer.pipeline.stages[-1].of("table").removeprefix("file:"))
    back = store.read_pipeline(str(tmp_path / name))
    assert {r.row_id: (r.score, r.prediction) for r in back(test).collect()} == before


def test_scaling_keeps_zeros_and_has_population_deviation(spark, parts):
    rows = [(i, [float(i % 2), 0.0, float(i), 7.0]) for i in range(10)]
    df = spark.createDataFrame(rows, "row_id long, v array<double>").withColumn("features", array_to_vector("v"))
    scale, varying = stages.scaler(df)
    assert varying == 2
    want = [1 / np.std([r[1][j] for r in rows]) if j in (0, 2) else 0.0 for j in range(4)]
    assert np.allclose(scale.getScalingVec().toArray(), want)
    sparse = df.withColumn("features", F.udf(lambda v: Vectors.sparse(4, [0], [v[0]]), VectorUDT())("v"))
    assert "Sparse" in type(scale.transform(sparse).first().scaled).__name__


def test_logistic_gradient_vanishes(parts):
    """Of the weighted, penalised loss over centred and scaled features, at the weights fitted without centring."""
    train, _ = parts
    scorer = models.fit("LogisticRegression", train, {"max_iter": 500})
    x = np.array([r.features.toArray() for r in train.orderBy("row_id").collect()])
    y = np.array([r.target for r in train.orderBy("row_id").collect()])
    std = x.std(0)
    z = np.where(std > 0, (x - x.mean(0)) / np.where(std > 0, std, 1), 0.0)
    w = scorer.model.coefficients.toArray()
    b = scorer.model.intercept + (w * np.where(std > 0, x.mean(0) / np.where(std > 0, std, 1), 0.0)).sum()
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    off = weight * (1 / (1 + np.exp(-(z @ w + b))) - y)
    assert np.abs(z.T @ off / weight.sum() + w / weight.sum()).max() < 1e-4 and abs(off.sum() / weight.sum()) < 1e-4


def test_naive_bayes_ranks_the_surest_rows(spark):
    """Log-odds against a plain program, of sparse rows whose scores are 0 or 1."""
    rng = random.Random(2)
    data = [(i, i % 2, [float(rng.random() < (0.8 if i % 2 else 0.1)) * (1 + j) for j in range(300)]) for i in range(60)]
    df = spark.createDataFrame(data, "row_id long, target int, v array<double>").withColumn("features", array_to_vector("v"))
    odds = {r.row_id: r.odds for r in models.fit("GaussianNB", df).pipeline.transform(df).select("row_id", "odds").collect()}
    x, y = np.array([d[2] for d in data]), np.array([d[1] for d in data])
    least = 1e-9 * x.var(0).max()
    say = lambda c: (-0.5 * (np.log(2 * np.pi * (x[y == c].var(0) + least)) + (x - x[y == c].mean(0)) ** 2 / (x[y == c].var(0) + least))).sum(1)
    assert np.allclose([odds[i] for i in range(60)], say(1) - say(0), rtol=1e-9) and len({round(o, 6) for o in odds.values()}) == 60


def test_partitions_follow_the_size():
    assert models.partitions_for(100, 50) == 4 and models.partitions_for(10**8, 2000) == 47_684


def test_same_seed_same_scores(parts):
    train, test = parts
    a, b = (models.fit_predict("RandomForest", train, test, FAST["RandomForest"]) for _ in range(2))
    assert a.exceptAll(b).count() == 0


def test_sweep_reports_failures_and_goes_on(parts):
    train, test = parts

    def broken():
        raise ValueError("no such backend")

    scored, status = models.sweep([("bad", broken), ("good", lambda: models.fit_predict("DecisionTree", train, test))])
    assert {s[0]: s[1] for s in status} == {"bad": "FAILED", "good": "OK"}
    assert {r.experiment for r in scored.select("experiment").distinct().collect()} == {"good"}


def test_stacking_and_linear_views(parts):
    train, test = parts
    members = {"tree": ("DecisionTree", {}), "bayes": ("GaussianNB", {})}
    out = ensemble.stack(train, test, members, "LogisticRegression", {"weights": None, "standard": False})
    assert out.count() == test.count()
    assert metrics.metric_rows(out.withColumn("g", F.lit(1)), ["g"]).first().ROC > 0.75


def test_search(spark, parts):
    train, test = parts
    assert search.grid_size() == 3600
    sampled = search.parameter_rows(search.sample_params(spark, 2))
    assert sampled == search.parameter_rows(search.sample_params(spark, 2))
    candidates = [{**search.forest_params(r), "trees": 5, "depth": 3} for r in sampled]
    broken = [*candidates, {"max_features": "no such rule"}]
    folds = search.cross_validate(train, candidates, method="oversampling").collect()
    assert sorted(r.cv_rank for r in folds) == [1, 2] and all(0.5 < r.mean_roc <= 1 for r in folds)
    ranked = search.evaluate_candidates(train, test, broken).orderBy("CandidateRank").collect()
    assert ranked[0].Test_ROC >= ranked[1].Test_ROC
    assert (ranked[2].candidate, ranked[2].Status, ranked[2].Test_ROC) == (2, "FAILED", None) and ranked[2].Error


def test_a_candidate_without_a_fold_has_no_mean(parts, monkeypatch):
    train, _ = parts
    whole, calls = models.fit_predict, []

    def flaky(name, part, held, params, seed):
        calls.append(params["trees"])
        if params["trees"] == 3 and calls.count(3) == 2:
            raise ValueError("lost")
        return whole(name, part, held, params, seed)

    monkeypatch.setattr(models, "fit_predict", flaky)
    rows = search.cross_validate(train, [{"trees": 2, "depth": 2}, {"trees": 3, "depth": 2}], parallelism=1).orderBy("candidate").collect()
    assert [(r.Status, r.mean_roc is None, r.cv_rank) for r in rows] == [("OK", False, 1), ("FAILED", True, 2)]


def test_scores_do_not_depend_on_how_rows_are_stored(parts):
    train, test = parts
    scores = [
        {r.row_id: r.score for r in models.fit_predict("RandomForest", train.repartition(n), test, FAST["RandomForest"]).collect()}
        for n in (1, 3, 8)
    ]
    assert scores[0] == scores[1] == scores[2]


def test_saved_model_scores_the_same(parts, tmp_path):
    from pyspark.ml.classification import DecisionTreeClassificationModel

    from scoreloom.sources.store import write_model

    train, test = parts
    scorer = models.fit("DecisionTree", train)
    write_model(scorer, str(tmp_path / "tree"))
    back = DecisionTreeClassificationModel.load(str(tmp_path / "tree"))
    again = {r.row_id: r.prediction for r in back.transform(test).select("row_id", "prediction").collect()}
    assert again == {r.row_id: float(r.prediction) for r in scorer(test).collect()}
