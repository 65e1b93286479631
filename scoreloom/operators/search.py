"""Random parameter search with fold scores and held-out evaluation."""

from __future__ import annotations

import json
import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from scoreloom.functions.hashing import order_key
from scoreloom.operators import models
from scoreloom.operators.metrics import METRICS, metric_rows, roc_auc
from scoreloom.operators.rank import candidate_rank
from scoreloom.operators.resample import to_ratio

# The forest search space.
FOREST_SPACE: Mapping[str, Sequence[object]] = {
    "n_estimators": (100, 150, 200, 250, 300),
    "max_depth": (None, 8, 15, 25),
    "min_samples_split": (2, 5, 10),
    "min_samples_leaf": (1, 2, 4, 6, 8),
    "max_features": ("sqrt", "log2", 0.5),
    "bootstrap": (True,),
    "class_weight": ("balanced", "balanced_subsample"),
    "criterion": ("gini", "entropy"),
}


def grid_size(space: Mapping[str, Sequence[object]] = FOREST_SPACE) -> int:
    return math.prod(len(values) for values in space.values())


def with_parameters(df: DataFrame, space: Mapping[str, Sequence[object]] = FOREST_SPACE, combo: str = "combo") -> DataFrame:
    """Decode a mixed-radix combination number into one text column per parameter."""
    step = 1
    columns = {}
    for name, values in reversed(list(space.items())):
        texts = F.array(*[F.lit("None" if v is None else str(v)) for v in values])
        columns[name] = F.get(texts, F.expr(f"({combo} div {step}) % {len(values)}").cast("int"))
        step *= len(values)
    return df.select("*", *[columns[name].alias(name) for name in space])


def sample_params(
    spark: SparkSession, n: int, seed: int = 42, space: Mapping[str, Sequence[object]] = FOREST_SPACE
) -> DataFrame:
    """n combinations without replacement, in seeded order; only those kept are decoded."""
    numbers = spark.range(grid_size(space)).withColumnRenamed("id", "combo")
    kept = numbers.orderBy(order_key(seed, "params", "combo"), "combo").limit(n)
    return with_parameters(kept, space)


def sample_params_by(
    datasets: DataFrame, dataset: str, n: int, seed: int = 42, space: Mapping[str, Sequence[object]] = FOREST_SPACE,
    place: str | None = None,
) -> DataFrame:
    """An independent sample of n combinations for every row of `datasets`."""
    numbers = datasets.withColumn("combo", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(grid_size(space) - 1).cast("bigint"))))
    w = Window.partitionBy(dataset).orderBy(order_key(seed, "params", dataset, "combo"), "combo")
    kept = numbers.withColumn("_at", F.row_number().over(w)).filter(F.col("_at") <= n)
    kept = kept.withColumnRenamed("_at", place) if place else kept.drop("_at")
    return with_parameters(kept, space)


def parameter_rows(sampled: DataFrame, names: Sequence[str] = tuple(FOREST_SPACE)) -> list[dict[str, str]]:
    """The sampled combinations as dicts; a search fits each of them, so they are few."""
    return [{n: r[n] for n in names} for r in sampled.collect()]


def forest_params(row: Mapping[str, str]) -> dict[str, object]:
    """Search-space row to forest arguments."""
    depth = row["max_depth"]
    return {
        "trees": int(row["n_estimators"]),
        "depth": models.MAX_DEPTH if depth == "None" else int(depth),
        "split": int(row["min_samples_split"]),
        "leaf": int(row["min_samples_leaf"]),
        "max_features": row["max_features"],
        "bootstrap": row["bootstrap"] == "True",
        "criterion": row["criterion"],
    }


def cross_validate(
    train: DataFrame,
    candidates: Sequence[Mapping[str, object]],
    k: int = 3,
    seed: int = 42,
    ratio: float = 1.0,
    method: str = "none",
    model: str = "RandomForest",
    parallelism: int = 4,
) -> DataFrame:
    """(candidate, Status, Error, mean_roc, std_roc, cv_rank) of every candidate; `train` carries `fold` by source row.

    A candidate without a score in one of its folds has no mean, and ranks last.

    Resampling happens inside each fold's training part, so copies of a row
    never reach its validation part.
    """
    jobs, parts = [], []
    for i in range(k):
        part = to_ratio(train.filter(F.col("fold") != i), ratio, method, seed=seed).persist()
        parts.append(part)
        held = train.filter(F.col("fold") == i)
        for c, params in enumerate(candidates):
            jobs.append(
                (f"{c}:{i}", lambda part=part, held=held, params=params: models.fit_predict(model, part, held, params, seed))
            )
    predictions, status = models.sweep(jobs, parallelism=parallelism)
    for part in parts:
        part.unpersist()
    if predictions is None:
        raise RuntimeError(f"all fits failed: {status}")
    scores = roc_auc(predictions, ["experiment"]).withColumn(
        "candidate", F.split("experiment", ":").getItem(0).cast("int")
    )
    sums = scores.groupBy("candidate").agg(
        F.count("ROC").alias("_folds"), F.avg("ROC").alias("mean_roc"), F.stddev_pop("ROC").alias("std_roc")
    )
    planned = _planned(train.sparkSession, len(candidates), [(int(name.split(":")[0]), *rest) for name, *rest in status])
    whole = F.col("_folds") == k
    table = planned.join(sums, "candidate", "left").withColumns(
        {m: F.when(whole, F.col(m)) for m in ("mean_roc", "std_roc")}
    ).drop("_folds")
    return candidate_rank(table.withColumn("_all", F.lit(1)), ["_all"], "mean_roc", "candidate", "cv_rank").drop("_all")


def evaluate_candidates(
    train: DataFrame,
    test: DataFrame,
    candidates: Sequence[Mapping[str, object]],
    seed: int = 42,
    model: str = "RandomForest",
    parallelism: int = 4,
) -> DataFrame:
    """Refit every candidate on the (resampled) training rows and rank by test ROC; failed ones have a status and no metrics."""
    jobs = [
        (str(c), lambda params=params: models.fit_predict(model, train, test, params, seed))
        for c, params in enumerate(candidates)
    ]
    predictions, status = models.sweep(jobs, parallelism=parallelism)
    if predictions is None:
        raise RuntimeError(f"all fits failed: {status}")
    rows = metric_rows(predictions, ["experiment"])
    rows = rows.select(
        F.col("experiment").cast("int").alias("candidate"),
        *[F.col(m).alias(m if m in ("TN", "FP", "FN", "TP") else f"Test_{m}") for m in METRICS],
    )
    texts = train.sparkSession.createDataFrame(
        [(c, json.dumps(dict(p), sort_keys=True)) for c, p in enumerate(candidates)], "candidate int, Params string"
    )
    planned = _planned(train.sparkSession, len(candidates), [(int(name), *rest) for name, *rest in status])
    table = planned.join(texts, "candidate").join(rows, "candidate", "left").withColumn("_all", F.lit(1))
    return candidate_rank(table, ["_all"], "Test_ROC", "candidate").drop("_all")


def _planned(spark: SparkSession, n: int, status: Sequence[tuple[int, str, str]]) -> DataFrame:
    """(candidate, Status, Error) of every candidate: OK only if all its fits are."""
    failed = {c: (state, message) for c, state, message in status if state != "OK"}
    return spark.createDataFrame(
        [(c, *failed.get(c, ("OK", ""))) for c in range(n)], "candidate int, Status string, Error string"
    )


def candidate_label(rank, trees, depth, leaf, features):
    """`rank r | n=.. | depth=.. | leaf=.. | feat=..`"""
    return F.concat_ws(
        " | ",
        F.concat(F.lit("rank "), rank.cast("string")),
        F.concat(F.lit("n="), trees),
        F.concat(F.lit("depth="), depth),
        F.concat(F.lit("leaf="), leaf),
        F.concat(F.lit("feat="), features),
    )
