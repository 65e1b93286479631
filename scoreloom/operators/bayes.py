"""Gaussian naive Bayes as grouped moments plus a row-local score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.numeric import threshold
from scoreloom.operators.clean import to_cells
from scoreloom.session import bounded_side, stored

SMOOTHING = 1e-9
CLIP = 700.0


def fit(train: DataFrame, values: str = "values", keys: Sequence[str] = ("dataset",), label: str = "target") -> DataFrame:
    """Per key: class log priors and arrays of class means and variances."""
    keys = list(keys)
    cells = to_cells(train, values, [*keys, label])
    per_class = cells.groupBy(*keys, "idx", label).agg(
        F.count(F.lit(1)).alias("_n"), F.avg("x").alias("mean"), F.var_pop("x").alias("_var")
    )
    feature = Window.partitionBy(*keys, "idx")
    n, mean = F.col("_n"), F.col("mean")
    overall_mean = F.sum(n * mean).over(feature) / F.sum(n).over(feature)
    off = mean - F.col("_m")
    widest = (
        per_class.withColumn("_m", overall_mean)
        .groupBy(*keys, "idx")
        .agg((F.sum(n * (F.col("_var") + off * off)) / F.sum(n)).alias("_v"))
        .groupBy(*keys)
        .agg((F.max("_v") * SMOOTHING).alias("_eps"))
    )
    smoothed = per_class.join(widest, keys).withColumn("variance", F.col("_var") + F.col("_eps"))
    arrays = smoothed.groupBy(*keys, label).agg(
        F.max("_n").alias("_rows"), F.array_sort(F.collect_list(F.struct("idx", "mean", "variance"))).alias("_params")
    )
    whole = Window.partitionBy(*keys)
    arrays = arrays.withColumn("_prior", F.ln(F.col("_rows") / F.sum("_rows").over(whole)))
    pick = lambda c, name: F.max(F.when(F.col(label) == c, F.col(name)))
    return arrays.groupBy(*keys).agg(
        pick(0, "_prior").alias("prior0"),
        pick(1, "_prior").alias("prior1"),
        pick(0, "_params").alias("params0"),
        pick(1, "_params").alias("params1"),
    )


def score(rows: DataFrame, model: DataFrame, values: str = "values", keys: Sequence[str] = ("dataset",)) -> DataFrame:
    """Add P(class 1) and the predicted class; one broadcast row per key, no shuffle."""
    keys = list(keys)

    def log_likelihood(params: str):
        terms = F.zip_with(
            values,
            params,
            lambda x, p: -0.5 * (F.ln(F.lit(6.283185307179586) * p["variance"]) + (x - p["mean"]) * (x - p["mean"]) / p["variance"]),
        )
        return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)

    gap = F.col("prior0") - F.col("prior1") + log_likelihood("params0") - log_likelihood("params1")
    clipped = F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), gap))
    scored = rows.join(bounded_side(model), keys).withColumn("score", 1.0 / (1.0 + F.exp(clipped)))
    return scored.withColumn("prediction", threshold(F.col("score"))).drop("prior0", "prior1", "params0", "params1")


def fit_cells(
    cells: DataFrame, classes: DataFrame, keys: Sequence[str] = ("dataset",), label: str = "target", smoothing: float = SMOOTHING
) -> tuple[DataFrame, DataFrame]:
    """((keys, idx, square, line), (keys, base)) from stored cells (keys, label, idx, x) and class counts (keys, label, n).

    Cells that are not stored are 0. The log-odds of a row of zeros are `base`; a cell x adds square x^2 + line x. A
    feature without a stored cell says the same of both classes and is left out.
    """
    keys = list(keys)
    held = cells.groupBy(*keys, "idx", label).agg(F.count("x").alias("_k"), F.avg("x").alias("_m"), F.var_pop("x").alias("_v"))
    every = held.select(*keys, "idx").distinct().join(classes.select(*keys, label, F.col("n").cast("double").alias("n")), keys)
    full = every.join(held, [*keys, "idx", label], "left").fillna(0, ["_k", "_m", "_v"])
    k, m, n = F.col("_k"), F.col("_m"), F.col("n")
    full = full.select(*keys, "idx", label, "n", (k * m / n).alias("mean"), ((k * F.col("_v") + k * (n - k) / n * m * m) / n).alias("var"))
    pick = lambda c, name: F.max(F.when(F.col(label) == c, F.col(name)))
    wide = full.groupBy(*keys, "idx").agg(*[pick(c, name).alias(f"{name}{c}") for c in (0, 1) for name in ("n", "mean", "var")])
    total = F.col("n0") + F.col("n1")
    middle = (F.col("n0") * F.col("mean0") + F.col("n1") * F.col("mean1")) / total
    spread = sum(F.col(f"n{c}") * (F.col(f"var{c}") + (F.col(f"mean{c}") - middle) ** 2) for c in (0, 1)) / total
    least = F.max(spread).over(Window.partitionBy(*keys)) * smoothing
    wide = stored(wide.withColumn("_eps", least).withColumns({f"v{c}": F.col(f"var{c}") + F.col("_eps") for c in (0, 1)}), "bayes")
    m0, m1, v0, v1 = (F.col(c) for c in ("mean0", "mean1", "v0", "v1"))
    params = wide.select(*keys, "idx", (0.5 / v0 - 0.5 / v1).alias("square"), (m1 / v1 - m0 / v0).alias("line"))
    zero = 0.5 * (F.ln(v0) - F.ln(v1) + m0 * m0 / v0 - m1 * m1 / v1)
    base = wide.groupBy(*keys).agg((F.ln(F.max("n1") / F.max("n0")) + F.sum(zero)).alias("base"))
    return params, base


def score_cells(
    rows: DataFrame, cells: DataFrame, model: tuple[DataFrame, DataFrame], keys: Sequence[str] = ("dataset",), row_id: str = "row_id"
) -> DataFrame:
    """rows (keys, row_id, ...) with odds, score and prediction; only stored cells (keys, row_id, idx, x) are read.

    `odds` are not cut off, so rows whose score is 0 or 1 to the last digit are still ranked by them.
    """
    params, base = model
    x = F.col("x")
    changes = cells.join(bounded_side(params), [*keys, "idx"]).groupBy(*keys, row_id)
    changes = changes.agg(F.sum(F.col("square") * x * x + F.col("line") * x).alias("_change"))
    odds = F.col("base") + F.coalesce("_change", F.lit(0.0))
    out = rows.join(bounded_side(base), list(keys)).join(changes, [*keys, row_id], "left").withColumn("odds", odds)
    out = out.drop("base", "_change").withColumn("score", 1.0 / (1.0 + F.exp(-F.col("odds"))))
    return out.withColumn("prediction", (F.col("odds") >= 0).cast("int"))
