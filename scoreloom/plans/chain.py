"""Steps 3 to 8 as one run: what a step chooses is written to a configuration table, which the next step reads.

A folder holds `results/step=/Dataset=` (every measured row, with its order) and `config/step=` (a row for each dataset).
A step whose configuration is there is not run again, so a run that was stopped goes on where it ended.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators import featurize, models, rank, report, resample, search
from scoreloom.plans import steps
from scoreloom.session import stored
from scoreloom.sources import store

# The steps in order.
ABLATION, SELECTION, COMPARISON, RESAMPLING, TUNING, ENSEMBLES = (
    "03_feature_ablation", "04_feature_selection", "05_model_search", "06_resampling", "07_tuning", "08_advanced_ensemble",
)

#: What a configuration row says; each step replaces what it chooses and carries the rest.
CHOICES = ("FeatureSet", "Features", "ModelType", "SamplingScenario", "SamplingRatio", "SamplingMethod", "Params")


@dataclass(frozen=True)
class Settings:
    """What the steps try. `select_on`: measure choices on `test` rows, or on `valid` rows inside the training part."""

    sets: Sequence[str] | None = None
    methods: Sequence[str] = ("ANOVA", "Chi2", "MutualInfo", "RF_importance")
    ks: Sequence[int] = (50, 100, 150, 200)
    models: Sequence[str] = tuple(models.PROFILES)
    model_params: Mapping[str, Mapping[str, object]] = field(default_factory=dict)
    forest: Mapping[str, object] = field(default_factory=dict)
    scenarios: Sequence[tuple[str, float | None, str]] = tuple(resample.SCENARIOS)
    candidates: int = 10
    space: Mapping[str, Sequence[object]] = field(default_factory=lambda: search.FOREST_SPACE)
    trees: int = 120
    rounds: int = 120
    views: Sequence[str] = ("ngram", "keys", "desc", "chargram", "keys_desc", "ngram_desc", "all_available")
    keep: int = 4
    select_on: str = "test"
    seed: int = 42


def read_config(spark: SparkSession, base: str, step: str) -> DataFrame | None:
    """The configuration that a step wrote; None if it has not ended."""
    try:
        return spark.read.parquet(f"{base}/config/step={step}")
    except AnalysisException:
        return None


def configured(config: DataFrame) -> dict[str, Row]:
    """Rows by dataset; there is one for each."""
    return {r.Dataset: r for r in config.collect()}


def choose(
    table: DataFrame, previous: DataFrame | None, step: str, select_on: str, takes: Mapping[str, str], metric: str = "ROC"
) -> DataFrame:
    """(Dataset, Step, SelectOn, choices..., ROC, AP, F1): the best row's values for `takes`, all others from `previous`."""
    best = rank.best_per_group(table, ["Dataset"], metric)
    own = best.select("Dataset", *[F.col(c).cast("string").alias(f"_{name}") for name, c in takes.items()], *report.COMPARED)
    if previous is None:
        carried = own.select("Dataset", *[F.lit(None).cast("string").alias(c) for c in CHOICES])
    else:
        carried = previous.select("Dataset", *CHOICES)
    joined = carried.join(own, "Dataset")
    choices = [(F.col(f"_{c}") if c in takes else F.col(c)).alias(c) for c in CHOICES]
    return joined.select("Dataset", F.lit(step).alias("Step"), F.lit(select_on).alias("SelectOn"), *choices, *report.COMPARED)


def sliced(ready: DataFrame, features: Sequence[int]) -> DataFrame:
    """Model input with the chosen features only."""
    cut = VectorSlicer(inputCol="features", outputCol="_cut", indices=list(features)).transform(ready)
    return cut.drop("features").withColumnRenamed("_cut", "features")


def _union(make: Callable[[str, Row], DataFrame], chosen: Mapping[str, Row]) -> DataFrame:
    return report.union_results([make(d, row) for d, row in sorted(chosen.items())])


def _sampling(row: Row) -> tuple[float, str]:
    ratio = row.SamplingRatio
    return (1.0 if ratio in (None, "None") else float(ratio)), row.SamplingMethod or "none"


def run(rows: DataFrame, families: Sequence[featurize.Family], datasets: Sequence[str], base: str, settings: Settings) -> dict[str, DataFrame]:
    """All steps over prepared rows; `config` has every step's choices, `gains` each step against the one before.

    The other results are those of `steps.collect`. Ties go to the row that a step lists first.
    """
    spark, s = rows.sparkSession, settings
    configs: list[DataFrame] = []
    inputs: dict[str, DataFrame] = {}

    def families_of(row: Row) -> list[featurize.Family]:
        return featurize.select_families(families, row.FeatureSet)

    def ready(d: str, row: Row) -> DataFrame:
        if d not in inputs:
            whole = steps.assembled(rows.filter(F.col("dataset") == d), families_of(row))
            inputs[d] = stored(sliced(whole, json.loads(row.Features)), "chosen")
        return inputs[d]

    def ablation(_: Mapping[str, Row]) -> DataFrame:
        table = steps.ablation(rows, families, datasets, s.sets, s.forest, s.seed, s.select_on)
        return table.withColumn("Params", F.lit(json.dumps(dict(s.forest), sort_keys=True)))

    def selection(chosen: Mapping[str, Row]) -> DataFrame:
        return _union(lambda d, row: steps.selection_grid(rows, families_of(row), [d], s.methods, s.ks, s.forest, s.seed, s.select_on), chosen)

    def comparison(chosen: Mapping[str, Row]) -> DataFrame:
        return _union(lambda d, row: steps.model_comparison(ready(d, row), [d], s.models, s.model_params, s.seed, select_on=s.select_on)[0], chosen)

    def resampling(chosen: Mapping[str, Row]) -> DataFrame:
        return _union(lambda d, row: steps.resampling(ready(d, row), [d], s.scenarios, s.forest, s.seed, s.select_on), chosen)

    def tuning(chosen: Mapping[str, Row]) -> DataFrame:
        def one(d: str, row: Row) -> DataFrame:
            table = steps.tuning(ready(d, row), d, *_sampling(row), n=s.candidates, seed=s.seed, space=s.space)
            table = table.withColumnsRenamed({c: c.removeprefix("Test_") for c in table.columns})
            return table.withColumn("SamplingScenario", F.lit(row.SamplingScenario)).withColumn("FeatureSet", F.lit(row.FeatureSet))

        return _union(one, chosen)

    def ensembles(chosen: Mapping[str, Row]) -> DataFrame:
        def one(d: str, row: Row) -> DataFrame:
            table = steps.ensembles(
                rows, families, d, row.FeatureSet, *_sampling(row), json.loads(row.Params), s.trees, s.rounds, s.seed, s.sets, s.views, s.keep
            )
            return table.withColumn("SamplingScenario", F.lit(row.SamplingScenario)).withColumn("FeatureStrategy", F.lit(row.FeatureSet))

        return _union(one, chosen)

    sampling = {c: c for c in ("SamplingScenario", "SamplingRatio", "SamplingMethod")}
    chain = (
        (ABLATION, ablation, {"FeatureSet": "FeatureSet", "Params": "Params"}, "ROC"),
        (SELECTION, selection, {"Features": "Features"}, "ROC"),
        (COMPARISON, comparison, {"ModelType": "ModelType"}, "ROC"),
        (RESAMPLING, resampling, sampling, "ROC"),
        (TUNING, tuning, {"Params": "Params"}, "ROC" if s.select_on == "test" else "mean_roc"),
        (ENSEMBLES, ensembles, {"ModelType": "ModelName"}, "ROC"),
    )
    for step, make, takes, metric in chain:
        previous = configs[-1] if configs else None
        config = read_config(spark, base, step)
        if config is None:
            store.write_results(make({} if previous is None else configured(previous)), f"{base}/results", step)
            table = store.read_results(spark, f"{base}/results", step)
            choose(table, previous, step, s.select_on, takes, metric).write.mode("overwrite").parquet(f"{base}/config/step={step}")
            config = read_config(spark, base, step)
        configs.append(config)

    order = [step for step, *_ in chain]
    tables = {step: store.read_results(spark, f"{base}/results", step) for step in order}
    gains = [
        report.gain(tables[now].select("Dataset", *report.COMPARED, rank.INPUT_ORDER), tables[before], now, before)
        for before, now in zip(order, order[1:], strict=False)
    ]
    sources = {step: [f"{base}/results/step={step}"] for step in order}
    out = steps.collect(spark, sources, datasets, baseline=families[0].name)
    return {**out, "config": report.union_results(configs), "gains": report.union_results(gains)}
