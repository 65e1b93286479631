"""The experiment steps: each plans its fits, runs them over stored rows and returns metric rows.

Rows carry `dataset, row_id, target, split` and either family columns or an
assembled `features` vector. All predictions of a step are written once and
measured in one grouped job.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators import clean, ensemble, featurize, metrics, models, rank, report, resample, score, search, split
from scoreloom.session import stored
from scoreloom.sources import delimited


@dataclass(frozen=True)
class Experiment:
    """One fit: rows come from `train` and `test`, `meta` becomes columns of its metric row."""

    name: str
    dataset: str
    train: Callable[[], DataFrame]
    test: Callable[[], DataFrame]
    model: str = "RandomForest"
    params: Mapping[str, object] = field(default_factory=dict)
    meta: Mapping[str, str] = field(default_factory=dict)

    @property
    def key(self) -> str:
        return f"{self.dataset}/{self.name}"


# Where a step trains and where it measures.
SELECT_ON: Mapping[str, tuple[str, str]] = {"test": ("train", "test"), "valid": ("fit", "valid")}
MARKS = ("dataset", "row_id", "target", "split", "inner", "fold")


def prepare(
    rows: DataFrame, families: Sequence[featurize.Family], test_size: float = 0.2, valid_size: float = 0.25, seed: int = 42
) -> DataFrame:
    """Labelled rows valid in every family with their split, inner split and fold, written once.

    Rows without a label are left out; families that disagree on which rows are valid are an error.
    """
    valid = clean.require_alignment(rows.filter(F.col("target").isNotNull()), [f.name for f in families])
    marked = split.stratified(valid, test_size=test_size, seed=seed)
    within = ("dataset", "split")
    inner = split.nested(marked, valid_size, seed, dataset=within)
    return stored(split.kfold(inner, seed=seed, dataset=within), "prepared")


def assembled(rows: DataFrame, families: Sequence[featurize.Family], policy: str = "zero") -> DataFrame:
    """Model input over `families`, written once for the many passes of a fit.

    Missing values become 0, or with policy `median` the median of the dataset's training rows.
    """
    wide = _filled(rows, families, policy).select(*MARKS, featurize.sparse_vector(families).alias("features"))
    return stored(wide, "assembled", vectors=["features"])


def family_vectors(rows: DataFrame, families: Sequence[featurize.Family], policy: str = "zero") -> DataFrame:
    """Each family as a vector column, written once for any number of feature sets; `input_of` joins those of a set."""
    vectors = [featurize.sparse_vector([f]).alias(f.name) for f in families]
    return stored(_filled(rows, families, policy).select(*MARKS, *vectors), "vectors", vectors=[f.name for f in families])


def input_of(vectors: DataFrame, families: Sequence[featurize.Family]) -> DataFrame:
    """Model input over `families` as `assembled` has it, from `family_vectors`; a reader scans the vectors it needs."""
    return featurize.joined(vectors, families).select(*MARKS, "features")


def _filled(rows: DataFrame, families: Sequence[featurize.Family], policy: str) -> DataFrame:
    for f in families:
        if f.kind == "dense":
            rows = clean.filled(rows, f.name, policy, rows.filter(F.col("split") == "train"))
    return rows


def part(rows: DataFrame, dataset: str, which: str) -> DataFrame:
    """`train` or `test` rows of a dataset, or the `fit` or `valid` rows inside its training part."""
    own = rows.filter(F.col("dataset") == dataset)
    if which in ("fit", "valid"):
        return own.filter((F.col("split") == "train") & (F.col("inner") == which))
    return own.filter(F.col("split") == which)


def run(
    experiments: Sequence[Experiment], step: str, seed: int = 42, parallelism: int = 4
) -> tuple[DataFrame, DataFrame, list[tuple[str, str, str]]]:
    """(metric rows, predictions, status rows) of a step; a failed experiment has a row with its status and no metrics."""
    jobs = [
        (e.key, lambda e=e: models.fit_predict(e.model, e.train(), e.test(), e.params, seed)) for e in experiments
    ]
    predictions, status = models.sweep(jobs, parallelism=parallelism)
    if predictions is None:
        raise RuntimeError(f"all experiments of {step} failed: {status}")
    names = sorted({m for e in experiments for m in e.meta})
    spark = predictions.sparkSession
    schema = ", ".join(["experiment string", "Dataset string", "Step string", "ModelType string", *[f"`{n}` string" for n in names], "Status string", "Error string"])
    ended = {name: (state, message) for name, state, message in status}
    meta = spark.createDataFrame(
        [(e.key, e.dataset, step, e.model, *[e.meta.get(n) for n in names], *ended[e.key]) for e in experiments], schema
    )
    table = meta.join(metrics.metric_rows(predictions, ["experiment"]), "experiment", "left")
    return table.select("Dataset", "Step", "ModelType", *names, *metrics.METRICS, "Status", "Error"), predictions, status


def ablation(
    rows: DataFrame, families: Sequence[featurize.Family], datasets: Sequence[str],
    sets: Sequence[str] | None = None, params: Mapping[str, object] | None = None, seed: int = 42,
    select_on: str = "test", reference: str | None = None,
) -> DataFrame:
    """One forest per dataset and feature set; rows of the set `reference` (the first family) are marked in Comparison."""
    learn, measure = SELECT_ON[select_on]
    experiments = []
    picked = {name: featurize.select_families(families, name) for name in sets or featurize.available_sets(families)}
    vectors = family_vectors(rows, [f for f in families if any(f in chosen for chosen in picked.values())])
    for name, chosen in picked.items():
        ready = input_of(vectors, chosen)
        experiments += [
            Experiment(
                name, d, lambda d=d, r=ready: part(r, d, learn), lambda d=d, r=ready: part(r, d, measure),
                params=params or {}, meta={"FeatureSet": name, "FeatureCount": str(sum(f.size for f in chosen))},
            )
            for d in datasets
        ]
    table = run(experiments, "03_feature_ablation", seed)[0]
    marked = F.when(F.col("FeatureSet") == (reference or families[0].name), "Reference").otherwise("")
    return table.withColumn("Comparison", marked)


def feature_ranking(
    rows: DataFrame, families: Sequence[featurize.Family], dataset: str, method: str, k: int,
    params: Mapping[str, object] | None = None, seed: int = 42, ready: DataFrame | None = None, learn: str = "train",
) -> list[int]:
    """Indices of the k best features by training rows; at most one entry per feature."""
    train = part(rows, dataset, learn)
    if method == "RF_importance":
        source = part(ready if ready is not None else assembled(rows, families), dataset, learn)
        importances = models.fit("RandomForest", source, params, seed).model.featureImportances.toArray()
        return sorted(range(len(importances)), key=lambda i: (-importances[i], i))[:k]
    cells = featurize.sparse_cells(train, families, ["dataset", "target"]).filter(F.col("x") != 0)
    classes = resample.class_distribution(train)
    if method == "ANOVA":
        scores = score.anova_f(score.class_moments(cells, classes))
    elif method == "Chi2":
        scores = score.chi2(score.class_moments(cells, classes))
    elif method == "MutualInfo":
        scores = score.mutual_info_binned(cells, classes)
    else:
        raise ValueError(f"unknown selection method: {method}")
    best = score.top_k(scores, ["dataset"], k).first()
    chosen = list(best["features"]) if best else []
    if len(chosen) < k:
        # Features that are 0 in every training row have score 0 and rank last.
        width = sum(f.size for f in families)
        chosen += [i for i in range(width) if i not in set(chosen)][: k - len(chosen)]
    return chosen


def selection_grid(
    rows: DataFrame, families: Sequence[featurize.Family], datasets: Sequence[str], methods: Sequence[str],
    ks: Sequence[int], params: Mapping[str, object] | None = None, seed: int = 42, select_on: str = "test",
) -> DataFrame:
    """One forest per dataset, method and k over the selected features."""
    learn, measure = SELECT_ON[select_on]
    ready = assembled(rows, families)
    width = sum(f.size for f in families)
    experiments = []
    for d in datasets:
        for method in methods:
            order = feature_ranking(rows, families, d, method, min(max(ks), width), params, seed, ready, learn)
            for k in ks:
                chosen = order[: min(k, width)]
                slicer = VectorSlicer(inputCol="features", outputCol="_cut", indices=chosen)

                def cut(which, d=d, slicer=slicer):
                    sliced = slicer.transform(part(ready, d, which)).drop("features")
                    return sliced.withColumnRenamed("_cut", "features")

                label = f"{method}_top{len(chosen)}"
                experiments.append(
                    Experiment(
                        label, d, lambda cut=cut: cut(learn), lambda cut=cut: cut(measure), params=params or {},
                        meta={
                            "SelectionMethod": method, "K": str(len(chosen)), "RequestedK": str(k), "SelectionLabel": label,
                            "Features": json.dumps(chosen),
                        },
                    )
                )
    return run(experiments, "04_feature_selection", seed)[0]


def model_comparison(
    ready: DataFrame, datasets: Sequence[str], names: Sequence[str] = tuple(models.PROFILES),
    params: Mapping[str, Mapping[str, object]] | None = None, seed: int = 42, parallelism: int = 4,
    select_on: str = "test",
) -> tuple[DataFrame, list[tuple[str, str, str]]]:
    """Every named classifier on every dataset; rows of the carried-forward forest are marked."""
    learn, measure = SELECT_ON[select_on]
    experiments = [
        Experiment(n, d, lambda d=d: part(ready, d, learn), lambda d=d: part(ready, d, measure), n, (params or {}).get(n, {}))
        for d in datasets
        for n in names
    ]
    table, _, status = run(experiments, "05_model_search", seed, parallelism)
    decision = F.when(F.col("ModelType") == "RandomForest", "Continue with RandomForest")
    return table.withColumn("NextStepDecision", decision), status


def resampling(
    ready: DataFrame, datasets: Sequence[str], scenarios=resample.SCENARIOS,
    params: Mapping[str, object] | None = None, seed: int = 42, select_on: str = "test",
) -> DataFrame:
    """A forest per dataset and scenario; only training rows are resampled."""
    learn, measure = SELECT_ON[select_on]
    experiments = []
    for d in datasets:
        for name, ratio, method in scenarios:
            experiments.append(
                Experiment(
                    name, d,
                    lambda d=d, r=ratio, m=method: stored(resample.to_ratio(part(ready, d, learn), r, m, seed=seed), "resampled"),
                    lambda d=d: part(ready, d, measure), params=params or {},
                    meta={"SamplingScenario": name, "SamplingMethod": method, "SamplingRatio": str(ratio)},
                )
            )
    table = run(experiments, "06_resampling", seed)[0]
    learned = ready.filter("split = 'train'" if learn == "train" else "split = 'train' and inner = 'fit'")
    counts = resample.scenario_counts(learned).withColumnRenamed("dataset", "Dataset")
    counts = counts.drop("SamplingMethod", "SamplingRatio")
    return table.join(counts, ["Dataset", "SamplingScenario"], "left")


def tuning(
    ready: DataFrame, dataset: str, ratio: float, method: str, n: int = 10, k: int = 3, seed: int = 42,
    space: Mapping[str, Sequence[object]] = search.FOREST_SPACE,
) -> DataFrame:
    """Sampled forest settings with fold scores and test metrics; a smaller `space` makes for cheaper fits."""
    spark = ready.sparkSession
    rows = search.parameter_rows(search.sample_params(spark, n, seed, space), tuple(space))
    candidates = [search.forest_params(r) for r in rows]
    train, test = part(ready, dataset, "train"), part(ready, dataset, "test")
    folds = search.cross_validate(train, candidates, k, seed, ratio, method)
    grown = stored(resample.to_ratio(train, ratio, method, seed=seed), "resampled")
    table = search.evaluate_candidates(grown, test, candidates, seed).join(folds.drop("Status", "Error"), "candidate")
    named = spark.createDataFrame([(i, *[r[p] for p in space]) for i, r in enumerate(rows)], ", ".join(["candidate int", *[f"{p} string" for p in space]]))
    out = table.join(F.broadcast(named), "candidate").withColumn("Dataset", F.lit(dataset))
    return out.withColumn(
        "CandidateLabel",
        search.candidate_label(F.col("CandidateRank"), F.col("n_estimators"), F.col("max_depth"), F.col("min_samples_leaf"), F.col("max_features")),
    )


def strong_members(
    forest: Mapping[str, object] | None = None, gatekeeper: bool = True, trees: int = 120, rounds: int = 120
) -> dict[str, tuple[str, Mapping[str, object]]]:
    """Members of the voting and stacking models."""
    members: dict[str, tuple[str, Mapping[str, object]]] = {}
    if gatekeeper:
        members["gatekeeper_rf"] = ("RandomForest", dict(forest or {}))
    members["extra_trees"] = ("ExtraTrees", {"trees": trees})
    members["hist_gradient_boosting"] = ("HistGradientBoosting", {"rounds": rounds, "step": 0.06})
    members["gradient_boosting"] = ("GradientBoosting", {"rounds": rounds, "step": 0.05, "depth": 3})
    return members


def view_scores(
    rows: DataFrame, families: Sequence[featurize.Family], datasets: Sequence[str], sets: Sequence[str],
    ratio: float = 1.0, method: str = "none", params: Mapping[str, object] | None = None, seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(validation, test) scores per feature set: an inner fit for validation, a full fit for test."""
    jobs = []
    picked = {name: featurize.select_families(families, name) for name in sets}
    vectors = family_vectors(rows, [f for f in families if any(f in chosen for chosen in picked.values())])
    for name, chosen in picked.items():
        ready = input_of(vectors, chosen)
        for d in datasets:
            fit = resample.to_ratio(part(ready, d, "fit"), ratio, method, seed=seed)
            full = resample.to_ratio(part(ready, d, "train"), ratio, method, seed=seed)
            held, test = part(ready, d, "valid"), part(ready, d, "test")
            jobs.append((f"{d}/valid/{name}", lambda f=fit, h=held: models.fit_predict("RandomForest", f, h, params, seed)))
            jobs.append((f"{d}/test/{name}", lambda f=full, t=test: models.fit_predict("RandomForest", f, t, params, seed)))
    scores, status = models.sweep(jobs)
    failed = [s for s in status if s[1] != "OK"]
    if failed:
        raise RuntimeError(f"view fits failed: {failed}")
    scores = scores.select(
        F.split("experiment", "/")[0].alias("dataset"), F.split("experiment", "/")[1].alias("_part"),
        F.split("experiment", "/")[2].alias("FeatureSet"), "row_id", "target", "score", "prediction",
    )
    return scores.filter("_part = 'valid'").drop("_part"), scores.filter("_part = 'test'").drop("_part")


def ensembles(
    rows: DataFrame, families: Sequence[featurize.Family], dataset: str, feature_set: str, ratio: float, method: str,
    forest: Mapping[str, object] | None = None, trees: int = 120, rounds: int = 120, seed: int = 42,
    sets: Sequence[str] | None = None, views: Sequence[str] = ("ngram", "keys", "desc", "chargram", "keys_desc", "ngram_desc", "all_available"),
    keep: int = 4,
) -> DataFrame:
    """Gatekeeper, voting, stacking, top-view and multi-view rows of one dataset."""
    ready = assembled(rows, featurize.select_families(families, feature_set))
    train = stored(resample.to_ratio(part(ready, dataset, "train"), ratio, method, seed=seed), "resampled")
    test = part(ready, dataset, "test")
    members, rest = strong_members(forest, True, trees, rounds), strong_members(forest, False, trees, rounds)
    jobs = [(name, lambda m=m, p=p: models.fit_predict(m, train, test, p, seed)) for name, (m, p) in members.items()]
    single, status = models.sweep(jobs)
    failed = [s for s in status if s[1] != "OK"]
    if failed:
        raise RuntimeError(f"ensemble members failed: {failed}")
    weights = {name: 2.0 if name == "gatekeeper_rf" else 1.0 for name in members}
    names = sets or featurize.available_sets(families)
    valid, tested = view_scores(rows, families, [dataset], list(dict.fromkeys([*names, *views])), ratio, method, forest, seed)
    preferred = [v for v in views if v in featurize.available_sets(families)]
    linear, _ = ensemble.multiview_linear(valid, tested, preferred, seed=seed)
    tables = {
        ("Gatekeeper", "Gatekeeper"): single.filter("experiment = 'gatekeeper_rf'"),
        ("SameFeatureAdvanced", "Voting_With_Gatekeeper"): ensemble.soft_vote(single, "experiment", weights, []),
        ("SameFeatureAdvanced", "Voting_Without_Gatekeeper"): ensemble.soft_vote(single, "experiment", {n: 1.0 for n in rest}, []),
        ("SameFeatureAdvanced", "Stacking_LR_Meta_Passthrough_False"): ensemble.stack(
            train, test, members, "LogisticRegression", {"weights": None, "standard": False}, seed=seed
        ),
        ("SameFeatureAdvanced", "Stacking_RF_Meta_Passthrough_True"): ensemble.stack(
            train, test, rest, "RandomForest", {**(forest or {}), "trees": trees}, passthrough=True, seed=seed
        ),
        ("FeatureSetEnsemble", "Top4_FeatureSet_EqualWeight"): ensemble.top_k_views(
            valid.filter(F.col("FeatureSet").isin(list(names))), tested, keep=keep
        ),
        ("MultiView", "MultiView_EqualWeight"): ensemble.multiview_equal(tested, preferred),
        ("MultiView", "MultiView_LinearMeta"): linear,
    }
    union = None
    for (family, name), table in tables.items():
        scored = table.select(
            F.lit(dataset).alias("Dataset"), F.lit(family).alias("ModelFamily"), F.lit(name).alias("ModelName"),
            "row_id", "target", "score", "prediction",
        )
        union = scored if union is None else union.unionByName(scored)
    return metrics.metric_rows(union, ["Dataset", "ModelFamily", "ModelName"])


def collect(
    spark: SparkSession, sources: Mapping[str, Sequence[str]], datasets: Sequence[str], baseline: str = "morgan",
    tie: str = report.INPUT_ORDER, multi_line: bool = False,
) -> dict[str, DataFrame]:
    """Read every step's result table and report candidates, progression and the final choice.

    Of rows with the same ROC the first in its table is chosen, by file and by row in the file, whatever tasks read it.

    `sources` maps a step to its alternatives in order of preference; a step
    without a readable table is reported as missing and left out.
    """
    found, read = delimited.first_available(spark, sources, multi_line, ordered=True)
    used = {r.Step: r.SourceUsed for r in read.collect()}
    tables = [report.normalize(table, step, used[step], datasets) for step, table in found.items()]
    tables = [t for t in tables if t is not None]
    if not tables:
        raise RuntimeError("no candidate results were found")
    candidates = stored(report.union_results(tables), "candidates")
    lifted = stored(report.baseline_lift(candidates, baseline, ordinal=tie), "baseline")
    every = lifted.unionByName(candidates)
    selected = report.progression(every, tie)
    final = report.final_candidate(selected)
    return {
        "source_report": read,
        "candidates": every.orderBy("Dataset", F.col("ROC").desc()).drop(report.INPUT_ORDER),
        "progression": report.progression_deltas(selected).orderBy("Dataset", "StepOrder").drop(report.INPUT_ORDER),
        "final": final.drop(report.INPUT_ORDER),
        "baseline_vs_final": report.baseline_vs_final(lifted, final),
    }
