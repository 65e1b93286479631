"""Score combination over long prediction tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.functions.numeric import safe_score, threshold
from scoreloom.operators import models
from scoreloom.operators.metrics import metric_rows
from scoreloom.operators.rank import best_per_group
from scoreloom.session import bounded_side


def _decide(df: DataFrame) -> DataFrame:
    return df.withColumn("score", safe_score(F.col("score"))).withColumn("prediction", threshold(F.col("score")))


def soft_vote(
    predictions: DataFrame,
    member: str,
    weights: Mapping[str, float] | None = None,
    keys: Sequence[str] = ("dataset",),
    row_id: str = "row_id",
) -> DataFrame:
    """Weighted mean score per row over the members named in `weights` (all, equally, by default)."""
    rows = predictions.withColumn("_w", F.lit(1.0))
    if weights is not None:
        table = F.create_map(*[F.lit(x) for item in weights.items() for x in (item[0], float(item[1]))])
        rows = predictions.filter(F.col(member).isin(*weights)).withColumn("_w", F.try_element_at(table, F.col(member)))
    mean = F.sum(F.col("_w") * F.col("score")) / F.sum("_w")
    return _decide(rows.groupBy(*keys, row_id, "target").agg(mean.alias("score")))


def view_validation(
    validation: DataFrame, view: str = "FeatureSet", keys: Sequence[str] = ("dataset",)
) -> DataFrame:
    """ROC, AP and F1 of each view on the inner validation rows."""
    return metric_rows(validation, [*keys, view]).select(
        *keys,
        view,
        F.col("ROC").alias("InnerValidationROC"),
        F.col("AP").alias("InnerValidationAP"),
        F.col("F1").alias("InnerValidationF1"),
    )


def top_views(
    validation: DataFrame, view: str = "FeatureSet", keys: Sequence[str] = ("dataset",), keep: int = 4
) -> DataFrame:
    """The `keep` views with the best validation ROC; ties by name."""
    report = view_validation(validation, view, keys)
    return best_per_group(report, keys, "InnerValidationROC", view, keep)


def top_k_views(
    validation: DataFrame,
    test: DataFrame,
    view: str = "FeatureSet",
    keys: Sequence[str] = ("dataset",),
    row_id: str = "row_id",
    keep: int = 4,
) -> DataFrame:
    """Mean test score of the views chosen on validation."""
    chosen = bounded_side(top_views(validation, view, keys, keep).select(*keys, view))
    return soft_vote(test.join(chosen, [*keys, view], "left_semi"), view, None, keys, row_id)


def multiview_equal(
    test: DataFrame, views: Sequence[str], view: str = "FeatureSet", keys: Sequence[str] = ("dataset",), row_id: str = "row_id"
) -> DataFrame:
    """Mean score over the preferred views."""
    return soft_vote(test.filter(F.col(view).isin(*views)), view, None, keys, row_id)


def score_vectors(
    predictions: DataFrame, members: Sequence[str], member: str, keys: Sequence[str], row_id: str = "row_id", out: str = "features"
) -> DataFrame:
    """Long scores to one vector per row, in the order of `members`."""
    wide = predictions.groupBy(*keys, row_id, "target").pivot(member, list(members)).agg(F.first("score"))
    columns = [f"_s{i}" for i in range(len(members))]
    wide = wide.select(*keys, row_id, "target", *[F.col(f"`{m}`").alias(c) for m, c in zip(members, columns)])
    return VectorAssembler(inputCols=columns, outputCol=out).transform(wide).drop(*columns)


def stack(
    train: DataFrame,
    test: DataFrame,
    members: Mapping[str, tuple[str, Mapping[str, object]]],
    meta: str = "LogisticRegression",
    meta_params: Mapping[str, object] | None = None,
    passthrough: bool = False,
    k: int = 3,
    seed: int = 42,
    parallelism: int = 4,
) -> DataFrame:
    """Out-of-fold member scores train a meta model; members are refitted on all training rows.

    `train` carries `fold` by source row, so copies of a row share a fold.
    """
    jobs = []
    for name, (model, params) in members.items():
        jobs.append((f"full:{name}", lambda m=model, p=params: models.fit_predict(m, train, test, p, seed)))
        for i in range(k):
            jobs.append(
                (
                    f"oof:{name}",
                    lambda m=model, p=params, i=i: models.fit_predict(
                        m, train.filter(F.col("fold") != i), train.filter(F.col("fold") == i).dropDuplicates(["row_id"]), p, seed
                    ),
                )
            )
    scores, status = models.sweep(jobs, "job", parallelism)
    failed = [s for s in status if s[1] != "OK"]
    if failed:
        raise RuntimeError(f"stacking members failed: {failed}")
    names = list(members)
    scores = scores.withColumn("member", F.substring_index("job", ":", -1))
    fitted = score_vectors(scores.filter(F.col("job").startswith("oof:")), names, "member", [])
    asked = score_vectors(scores.filter(F.col("job").startswith("full:")), names, "member", [])
    copies = train.groupBy("row_id").agg(F.count(F.lit(1)).alias("_copies"))
    fitted = fitted.join(copies, "row_id").withColumn("copy_no", F.explode(F.expr("sequence(1L, _copies)"))).drop("_copies")
    if passthrough:
        fitted, asked = _with_features(fitted, train), _with_features(asked, test)
    return models.fit_predict(meta, fitted, asked, meta_params, seed)


def _with_features(scores: DataFrame, rows: DataFrame) -> DataFrame:
    source = rows.dropDuplicates(["row_id"]).select("row_id", F.col("features").alias("_x"))
    joined = scores.withColumnRenamed("features", "_s").join(source, "row_id")
    return VectorAssembler(inputCols=["_s", "_x"], outputCol="features").transform(joined).drop("_s", "_x")


def multiview_linear(
    validation: DataFrame, test: DataFrame, views: Sequence[str], view: str = "FeatureSet", seed: int = 42
) -> tuple[DataFrame, list[float]]:
    """Logistic regression over validation view scores applied to test view scores, with its weights."""
    fitted = score_vectors(validation, views, view, [])
    asked = score_vectors(test, views, view, [])
    scorer = models.fit("LogisticRegression", fitted, {"weights": None, "standard": False}, seed)
    return _decide(scorer(asked)), [round(float(w), 4) for w in scorer.model.coefficients]
