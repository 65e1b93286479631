"""Comparison and progression tables over metric rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.numeric import gain_percent
from scoreloom.operators.rank import INPUT_ORDER, best_per_group

COMPARED = ("ROC", "AP", "F1")

# Step names and their order.
STEP_ORDER: Mapping[str, int] = {
    "02_rf_morgan_baseline": 2,
    "03_feature_ablation": 3,
    "04_feature_selection": 4,
    "05_model_search": 5,
    "06_resampling": 6,
    "07_tuning": 7,
    "08_advanced_ensemble": 8,
}
BASELINE_STEP = "02_rf_morgan_baseline"
ABLATION_STEP = "03_feature_ablation"


def union_results(tables: Sequence[DataFrame]) -> DataFrame:
    """Row union by name; a column missing from a table is null there."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def gain(
    current: DataFrame, previous: DataFrame, current_name: str, previous_name: str, ordinal: str | None = None
) -> DataFrame:
    """Current rows beside the best previous row of their dataset, with deltas and gains; nulls where there is none."""
    best = best_per_group(previous, ["Dataset"], "ROC", ordinal).select(
        "Dataset", *[F.col(m).alias(f"Previous_{m}") for m in COMPARED]
    )
    out = (
        current.withColumn("CurrentStep", F.lit(current_name))
        .withColumn("ComparedWith", F.lit(previous_name))
        .join(best, "Dataset", "left")
    )
    for m in COMPARED:
        now, before = F.col(m), F.col(f"Previous_{m}")
        out = out.withColumn(f"{m}_Delta", now - before).withColumn(f"{m}_Gain_%", gain_percent(now, before))
    return out


def reference_vs_best(
    reference: DataFrame,
    candidates: DataFrame,
    reference_name: str,
    best_name: str,
    ordinal: str | None = None,
    versus: str = "Gatekeeper",
) -> DataFrame:
    """Two rows per dataset: the reference with zero deltas and the best candidate against it."""
    keep = ["Dataset", *[c for c in reference.columns if c in candidates.columns and c != "Dataset"]]
    base = reference.select("Dataset", *[F.col(m).alias(f"_{m}") for m in COMPARED])
    first = reference.select(*keep).withColumn("Comparison", F.lit(reference_name))
    for m in COMPARED:
        first = first.withColumn(f"{m}_Delta_vs_{versus}", F.lit(0.0)).withColumn(f"{m}_Gain_%", F.lit(0.0))
    best = (
        best_per_group(candidates, ["Dataset"], "ROC", ordinal)
        .select(*keep)
        .withColumn("Comparison", F.lit(best_name))
        .join(base, "Dataset", "left")
    )
    for m in COMPARED:
        now, before = F.col(m), F.col(f"_{m}")
        best = best.withColumn(f"{m}_Delta_vs_{versus}", now - before).withColumn(f"{m}_Gain_%", gain_percent(now, before))
    return first.unionByName(best.drop(*[f"_{m}" for m in COMPARED]))


def first_present(df: DataFrame, names: Sequence[str], default: str):
    """The first existing column, null or not; precedence is by schema, not by value."""
    for name in names:
        if name in df.columns:
            return F.col(name).cast("string")
    return F.lit(default)


def normalize(df: DataFrame, step: str, source: str, datasets: Sequence[str], order: Mapping[str, int] = STEP_ORDER) -> DataFrame | None:
    """A result table as candidate rows; None when it has no ROC or Dataset column."""
    if "ROC" not in df.columns or "Dataset" not in df.columns:
        return None
    comparison = first_present(df, ["Comparison"], "")
    model = (
        first_present(df, ["ModelName", "ModelType"], "")
        if {"ModelName", "ModelType"} & set(df.columns)
        else comparison
    )
    strategy = first_present(df, ["FeatureStrategy", "FeatureSet"], "")
    given = lambda c: c.isNotNull() & (c != "")
    nothing = F.lit(None).cast("string")
    label = (
        F.when(comparison.isNull(), nothing)
        .when(comparison != "", comparison)
        .when(model.isNull(), nothing)
        .when(model != "", model)
        .otherwise(strategy)
    )
    generic = label.isin("Best advanced ensemble", "Gatekeeper") & given(model)

    def metric(name):
        return (F.col(name) if name in df.columns else F.lit(None)).try_cast("double").alias(name)

    return df.filter(F.col("Dataset").isin(*datasets)).select(
        F.col("Dataset"),
        F.lit(step).alias("Step"),
        F.lit(order[step]).alias("StepOrder"),
        F.when(generic, F.concat(label, F.lit(": "), model)).otherwise(label).alias("CandidateLabel"),
        model.alias("ModelName"),
        first_present(df, ["ModelFamily", "ModelType"], "").alias("ModelFamily"),
        strategy.alias("FeatureStrategy"),
        first_present(df, ["SamplingScenario"], "none").alias("SamplingScenario"),
        *[metric(m) for m in ("ROC", "AP", "F1", "BalancedAccuracy")],
        F.lit(source).alias("SourceFile"),
        *[c for c in (INPUT_ORDER,) if c in df.columns],
    )


def baseline_lift(
    candidates: DataFrame, strategy: str = "morgan", label: str = "RF + Morgan baseline", model: str = "RandomForest",
    ordinal: str | None = None,
) -> DataFrame:
    """The reference row of the ablation step, relabelled as the baseline step."""
    picked = candidates.filter(
        (F.col("Step") == ABLATION_STEP)
        & (
            F.coalesce(F.lower("CandidateLabel").contains("reference"), F.lit(False))
            | F.coalesce(F.lower("FeatureStrategy") == strategy, F.lit(False))
        )
    )
    return best_per_group(picked, ["Dataset"], "ROC", ordinal).withColumns(
        {
            "Step": F.lit(BASELINE_STEP),
            "StepOrder": F.lit(STEP_ORDER[BASELINE_STEP]),
            "CandidateLabel": F.lit(label),
            "ModelName": F.lit(model),
            "ModelFamily": F.lit(model),
            "FeatureStrategy": F.lit(strategy),
            "SamplingScenario": F.lit("none"),
        }
    )


def progression(candidates: DataFrame, ordinal: str | None = None) -> DataFrame:
    """Best candidate of every (dataset, step)."""
    return best_per_group(candidates, ["Dataset", "Step"], "ROC", ordinal)


def final_candidate(selected: DataFrame) -> DataFrame:
    """The row of the last step per dataset, which need not be the best one."""
    w = Window.partitionBy("Dataset").orderBy(F.col("StepOrder").desc())
    return selected.withColumn("_last", F.row_number().over(w)).filter("_last = 1").drop("_last")


def progression_deltas(selected: DataFrame) -> DataFrame:
    """Metric minus the previous selected step of the same dataset."""
    w = Window.partitionBy("Dataset").orderBy("StepOrder")
    return selected.withColumns(
        {f"{m}_Delta_vs_Previous_Selected": F.col(m) - F.lag(m).over(w) for m in COMPARED}
    )


def baseline_vs_final(baseline: DataFrame, final: DataFrame) -> DataFrame:
    """Baseline and final candidate of each dataset side by side; nulls where a dataset has only one of them."""
    left = baseline.select(
        "Dataset",
        F.col("Step").alias("BaselineStep"),
        F.col("CandidateLabel").alias("BaselineCandidate"),
        F.col("ModelName").alias("BaselineModel"),
        F.col("FeatureStrategy").alias("BaselineFeatureStrategy"),
        F.col("SamplingScenario").alias("BaselineSamplingScenario"),
        *[F.col(m).alias(f"Baseline_{m}") for m in COMPARED],
    )
    right = final.select(
        "Dataset",
        F.col("Step").alias("FinalStep"),
        F.col("CandidateLabel").alias("FinalCandidate"),
        F.col("ModelName").alias("FinalModel"),
        F.col("ModelFamily").alias("FinalModelFamily"),
        F.col("FeatureStrategy").alias("FinalFeatureStrategy"),
        F.col("SamplingScenario").alias("FinalSamplingScenario"),
        *[F.col(m).alias(f"Final_{m}") for m in COMPARED],
    )
    out = left.join(right, "Dataset", "full")
    for m in COMPARED:
        now, before = F.col(f"Final_{m}"), F.col(f"Baseline_{m}")
        out = out.withColumn(f"{m}_Delta", now - before).withColumn(f"{m}_Gain_%", gain_percent(now, before))
    return out


def best_challenger(results: DataFrame, family: str = "ModelFamily", reference: str = "Gatekeeper", ordinal: str | None = None) -> DataFrame:
    """Best row per dataset that is not the reference."""
    return best_per_group(results.filter(F.col(family) != reference), ["Dataset"], "ROC", ordinal)


def top_n(results: DataFrame, metric: str, n: int, tie: Sequence[str]) -> DataFrame:
    """The n best rows, shown in rising order."""
    return results.orderBy(F.col(metric).desc_nulls_last(), *tie).limit(n).orderBy(metric, *tie)
