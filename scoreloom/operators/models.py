"""Named classifiers on Spark ML: fit on training rows, return scored rows.

Training rows carry `row_id, target, features`; scored rows carry
`row_id, target, score, prediction`. Profiles whose algorithm Spark does not
have are approximations and say so in PROFILES.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators import stages
from scoreloom.operators.split import kfold
from scoreloom.session import materialise, scratch_path

SCORED = ("row_id", "target", "score", "prediction")
MAX_DEPTH = 30  # deepest tree Spark grows
FIT_PARTITIONS, PART_BYTES = 4, 32 << 20  # least partitions of the training rows, and most bytes of one


@dataclass(frozen=True)
class Profile:
    """Default parameters of a named classifier and how close it is to its namesake."""

    fit: Callable[..., Callable[[DataFrame], DataFrame]]
    params: Mapping[str, object] = field(default_factory=dict)
    note: str = ""


def balanced_weights(train: DataFrame, out: str = "weight") -> DataFrame:
    """Weight n / (2 * n_class); the two counts are the only values fetched."""
    n, pos = train.agg(F.count(F.lit(1)), F.sum("target")).first()
    pos = pos or 0
    heavy, light = (n / (2 * c) if c else 0.0 for c in (pos, n - pos))
    return train.withColumn(out, F.when(F.col("target") == 1, heavy).otherwise(light))


def scorer(pipeline: PipelineModel, model=None) -> Callable[[DataFrame], DataFrame]:
    """Rows to scored rows. `.pipeline` has every fitted step and can be saved; `.model` is the Spark model in it, if one."""

    def run(df: DataFrame) -> DataFrame:
        return pipeline.transform(df).select("row_id", F.col("target").cast("int").alias("target"), "score", "prediction")

    run.pipeline, run.model = pipeline, model
    return run


def _fitted(*steps, model=None) -> Callable[[DataFrame], DataFrame]:
    return scorer(PipelineModel(list(steps)), model)


def _subset(max_features: object) -> str:
    return str(max_features)


def _forest(train: DataFrame, seed: int, trees, depth, leaf=1, split=2, max_features="sqrt", bootstrap=True,
            criterion="gini", weights="balanced", bins=32, **columns):
    rows = balanced_weights(train) if weights else train.withColumn("weight", F.lit(1.0))
    return RandomForestClassifier(
        labelCol="target", weightCol="weight", numTrees=int(trees), maxDepth=min(int(depth or MAX_DEPTH), MAX_DEPTH),
        minInstancesPerNode=max(int(leaf), math.ceil(int(split) / 2)), featureSubsetStrategy=_subset(max_features),
        bootstrap=bool(bootstrap), impurity=criterion, maxBins=bins, seed=seed, cacheNodeIds=True,
        checkpointInterval=10, maxMemoryInMB=512, **columns,
    ).fit(rows)


def fit_forest(train: DataFrame, seed: int, trees=300, depth=MAX_DEPTH, leaf=1, split=2, max_features="sqrt",
               bootstrap=True, criterion="gini", weights="balanced", bins=32):
    model = _forest(train, seed, trees, depth, leaf, split, max_features, bootstrap, criterion, weights, bins)
    return _fitted(model, stages.Probability(), model=model)


def fit_boosted(train: DataFrame, seed: int, rounds=100, step=0.1, depth=3, bins=32, rate=1.0, max_features="all"):
    model = GBTClassifier(
        labelCol="target", maxIter=int(rounds), stepSize=float(step), maxDepth=int(depth), maxBins=int(bins),
        subsamplingRate=float(rate), featureSubsetStrategy=_subset(max_features), seed=seed, cacheNodeIds=True,
        checkpointInterval=10,
    ).fit(train)
    return _fitted(model, stages.Probability(), model=model)


def fit_tree(train: DataFrame, seed: int, depth=8):
    model = DecisionTreeClassifier(
        labelCol="target", weightCol="weight", maxDepth=int(depth), seed=seed, cacheNodeIds=True
    ).fit(balanced_weights(train))
    return _fitted(model, stages.Probability(), model=model)


def fit_logistic(train: DataFrame, seed: int, c=1.0, max_iter=200, weights="balanced", standard=True):
    scale = [stages.scaler(train)[0]] if standard else []
    rows = balanced_weights(train) if weights else train.withColumn("weight", F.lit(1.0))
    total = rows.agg(F.sum("weight")).first()[0]
    model = LogisticRegression(
        featuresCol="scaled" if standard else "features", labelCol="target", weightCol="weight",
        regParam=1.0 / (float(c) * total), elasticNetParam=0.0, standardization=False, maxIter=int(max_iter),
    ).fit(scale[0].transform(rows) if standard else rows)
    return _fitted(*scale, model, stages.Probability(), model=model)


def _calibrated(train: DataFrame, seed: int, max_iter: int, reg: float, features: str, folds: int = 3) -> list:
    """Steps of a linear SVM per fold with a sigmoid fitted on the held-out fold; scores are averaged."""
    marked = train if "fold" in train.columns else _with_folds(train, folds, seed)
    marked = marked.persist(StorageLevel.MEMORY_AND_DISK)
    members, slopes, offsets = [], [], []
    for i in range(folds):
        svm = LinearSVC(
            featuresCol=features, labelCol="target", weightCol="weight", maxIter=max_iter, regParam=reg,
            standardization=False, rawPredictionCol=f"margin{i}", predictionCol=f"said{i}",
        ).fit(balanced_weights(marked.filter(F.col("fold") != i)))
        held = svm.transform(marked.filter(F.col("fold") == i)).select(
            "target", F.array(vector_to_array(f"margin{i}")[1]).alias("_m")
        )
        sigmoid = LogisticRegression(labelCol="target", featuresCol="_v", predictionCol="_p", rawPredictionCol="_r",
                                     probabilityCol="_q", maxIter=100).fit(
            held.withColumn("_v", array_to_vector("_m"))
        )
        members.append(svm)
        slopes.append(float(sigmoid.coefficients[0]))
        offsets.append(float(sigmoid.intercept))
    marked.unpersist()
    columns = [f"margin{i}" for i in range(folds)]
    return [*members, stages.Margin(columns=columns, slopes=slopes, offsets=offsets)]


def _with_folds(train: DataFrame, folds: int, seed: int) -> DataFrame:
    """Folds by source row, so copies of one row never sit on both sides."""
    source = train.select("row_id", "target").distinct().withColumn("_one", F.lit("train"))
    marked = kfold(source, folds, seed=seed, dataset=("_one",)).select("row_id", "fold")
    return train.join(marked, "row_id")


def fit_linear_svm(train: DataFrame, seed: int, max_iter=100, c=1.0):
    scale, _ = stages.scaler(train)
    return _fitted(scale, *_calibrated(scale.transform(train), seed, int(max_iter), 1.0 / (float(c) * train.count()), "scaled"))


def fit_rbf_svm(train: DataFrame, seed: int, size=256, c=3.0, max_iter=100):
    """Random Fourier features of the kernel whose gamma is 1 / (features that vary), as their variance is 1."""
    scale, varying = stages.scaler(train)
    rename = stages.Rename(source="scaled", target="features")
    width, n = train.select("features").first()[0].size, train.count()
    project = stages.FourierMap(width=width, size=int(size), gamma=1.0 / max(1, varying), seed=seed)
    ready = project.transform(rename.transform(scale.transform(train)))
    return _fitted(scale, rename, project, *_calibrated(ready, seed, int(max_iter), 1.0 / (float(c) * n), "features"))


def fit_extra_trees(train: DataFrame, seed: int, trees=300, depth=MAX_DEPTH, max_features="sqrt", groups=4, cuts=4):
    """Forests without bootstrap over features cut at random thresholds, averaged."""
    ends = train.select(Summarizer.metrics("min", "max").summary(F.col("features")).alias("m")).select("m.min", "m.max").first()
    low, high = ends[0].toArray(), ends[1].toArray()
    rng = np.random.RandomState(seed)
    steps = []
    for g in range(groups):
        edges = np.sort(low[:, None] + rng.uniform(size=(len(low), cuts)) * (high - low)[:, None], axis=1)
        cut = stages.RandomCuts(edges=json.dumps(edges.tolist()), into=f"cut{g}")
        own = {"featuresCol": f"cut{g}", "probabilityCol": f"chance{g}", "rawPredictionCol": f"raw{g}", "predictionCol": f"said{g}"}
        steps += [cut, _forest(cut.transform(train), seed + g, max(1, trees // groups), depth, max_features=max_features,
                               bootstrap=False, bins=max(2, cuts + 1), **own)]
    return _fitted(*steps, stages.MeanProbability(columns=[f"chance{g}" for g in range(groups)]))


def fit_neighbours(train: DataFrame, seed: int, k=7):
    scale, _ = stages.scaler(train)
    rename = stages.Rename(source="scaled", target="features")
    path = scratch_path(train.sparkSession, "neighbours")
    ready = rename.transform(scale.transform(train))
    ready.select("row_id", "target", vector_to_array("features").alias("values")).write.parquet(path)
    return _fitted(scale, rename, stages.Neighbours(table=path, k=int(k), seed=seed))


def fit_gaussian_nb(train: DataFrame, seed: int, smoothing=1e-9):
    """Class moments from stored cells and counts; a row is then scored by its stored cells."""
    total, _, spread = stages.moments(train)
    n, mean, variance = zip(*(stages.moments(train.filter(F.col("target") == c)) if _has(train, c) else (0, 0.0, 0.0) for c in (0, 1)))
    if not all(n):
        sure = 1e6 if n[1] else -1e6
        return _fitted(stages.GaussianBayes(base=sure, squares=[0.0] * len(spread), lines=[0.0] * len(spread)))
    least = smoothing * spread.max(initial=0.0) or smoothing
    v0, v1 = variance[0] + least, variance[1] + least
    zero = 0.5 * (np.log(v0) - np.log(v1) + mean[0] ** 2 / v0 - mean[1] ** 2 / v1)
    base = math.log(n[1] / n[0]) + zero.sum()
    squares, lines = 0.5 / v0 - 0.5 / v1, mean[1] / v1 - mean[0] / v0
    return _fitted(stages.GaussianBayes(base=float(base), squares=squares.tolist(), lines=lines.tolist()))


def _has(train: DataFrame, target: int) -> bool:
    return not train.filter(F.col("target") == target).isEmpty()


# The twelve names, and what of each is left when Spark's learners stand in.
PROFILES: Mapping[str, Profile] = {
    "LogisticRegression": Profile(fit_logistic, {}, "intercept is not penalised"),
    "kNN": Profile(fit_neighbours, {"k": 7}, "exact"),
    "LinearSVM": Profile(fit_linear_svm, {}, "hinge loss, three-fold sigmoid calibration"),
    "RBF_SVM": Profile(fit_rbf_svm, {"size": 256, "c": 3.0}, "approximation: random Fourier features"),
    "RandomForest": Profile(fit_forest, {"trees": 300}, "binned splits, depth at most 30, global class weights"),
    "ExtraTrees": Profile(fit_extra_trees, {"trees": 300}, "approximation: random cuts per forest group"),
    "GradientBoosting": Profile(fit_boosted, {"rounds": 100, "step": 0.1, "depth": 3}, "binned splits"),
    "HistGradientBoosting": Profile(fit_boosted, {"rounds": 120, "step": 0.08, "depth": 5, "bins": 255}, "profile: no leaf cap or l2"),
    "GaussianNB": Profile(fit_gaussian_nb, {}, "exact"),
    "DecisionTree": Profile(fit_tree, {"depth": 8}, "binned splits"),
    "XGBoost": Profile(
        fit_boosted, {"rounds": 300, "step": 0.05, "depth": 4, "rate": 0.9, "max_features": 0.9},
        "profile: Spark boosted trees with row and column subsampling",
    ),
    "CatBoost": Profile(fit_boosted, {"rounds": 300, "step": 0.05, "depth": 4}, "profile: Spark boosted trees of depth 4"),
}


def partitions_for(rows: int, width: int) -> int:
    """Partitions of a training set, so that one holds at most PART_BYTES of features if no cell were 0."""
    return max(FIT_PARTITIONS, -(-rows * width * 8 // PART_BYTES))


def settled(train: DataFrame, partitions: int | None = None) -> DataFrame:
    """Training rows dealt by a hash of their id and ordered within each partition.

    Learners draw by partition, so a fit depends on this layout; it follows from the number of rows and features alone
    (or `partitions`), however the rows are stored.
    """
    if partitions is None:
        row = train.select("features").first()
        partitions = partitions_for(train.count(), row[0].size) if row else 1
    order = [c for c in ("row_id", "copy_no") if c in train.columns]
    return train.repartition(partitions, "row_id").sortWithinPartitions(*order)


def fit(
    name: str, train: DataFrame, params: Mapping[str, object] | None = None, seed: int = 42, partitions: int | None = None
):
    """Fit a named classifier; the result maps rows to scored rows and has the fitted `.pipeline`."""
    profile = PROFILES[name]
    cached = settled(train, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if cached.isEmpty():
            raise ValueError("no training rows")
        return profile.fit(cached, seed, **{**profile.params, **(params or {})})
    finally:
        cached.unpersist()


def fit_predict(name: str, train: DataFrame, test: DataFrame, params: Mapping[str, object] | None = None, seed: int = 42) -> DataFrame:
    return fit(name, train, params, seed)(test)


def sweep(
    jobs: Sequence[tuple[str, Callable[[], DataFrame]]], key: str = "experiment", parallelism: int = 4,
) -> tuple[DataFrame | None, list[tuple[str, str, str]]]:
    """Run experiments from a driver thread pool.

    Returns the union of their predictions, written once, and (experiment,
    status, message) rows. A failing experiment is reported and skipped.
    """

    def run(job):
        name, make = job
        try:
            return name, make().withColumn(key, F.lit(name)), "OK", ""
        except Exception as error:  # noqa: BLE001
            return name, None, "FAILED", f"{type(error).__name__}: {error}"

    with ThreadPool(max(1, min(parallelism, len(jobs)))) as pool:
        done = pool.map(inheritable_thread_target(SparkSession.getActiveSession())(run), jobs)
    status = [(name, state, message) for name, _, state, message in done]
    parts = [df for _, df, _, _ in done if df is not None]
    if not parts:
        return None, status
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return materialise(union), status
