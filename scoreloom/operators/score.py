"""Per-feature scores against a binary target, from one grouped pass over sparse cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.session import bounded_side, stored

MAX_DOUBLE = 1.7976931348623157e308


def class_moments(
    cells: DataFrame, class_rows: DataFrame, dataset: Sequence[str] = ("dataset",), label: str = "target"
) -> DataFrame:
    """Mean and central sum of squares per (feature, class), absent cells counted as 0.

    `cells` holds (dataset, row, label, idx, x) for non-zero values; `class_rows`
    holds (dataset, label, rows). Zeros enter by merging moments, so wide bit
    families stay sparse and only one row per feature and class leaves a task.
    """
    keys = [*dataset, "idx"]
    seen = cells.groupBy(*keys, label).agg(
        F.count(F.lit(1)).alias("_k"),
        F.avg("x").alias("_avg"),
        F.var_pop("x").alias("_var"),
        F.sum("x").alias("total"),
        F.min("x").alias("_min"),
        F.max("x").alias("_max"),
    )
    # One row per feature with its classes in a map, so the cells are aggregated once.
    measures = F.struct("_k", "_avg", "_var", "total", "_min", "_max")
    per_feature = seen.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(label, measures))).alias("_by"))
    grid = per_feature.join(class_rows, list(dataset)).withColumn("_c", F.try_element_at("_by", F.col(label)))
    zeros = F.col("rows") - F.coalesce("_k", F.lit(0))
    k, avg = F.coalesce("_k", F.lit(0)), F.coalesce("_avg", F.lit(0.0))
    return (
        grid.select(*keys, label, "rows", "_c.*")
        .select(
            *keys,
            label,
            "rows",
            F.coalesce("total", F.lit(0.0)).alias("total"),
            (k * avg / F.col("rows")).alias("mean"),
            (k * F.coalesce("_var", F.lit(0.0)) + avg * avg * k * zeros / F.col("rows")).alias("spread"),
            F.when(zeros > 0, F.least(F.coalesce("_min", F.lit(0.0)), F.lit(0.0))).otherwise(F.col("_min")).alias("low"),
            F.when(zeros > 0, F.greatest(F.coalesce("_max", F.lit(0.0)), F.lit(0.0))).otherwise(F.col("_max")).alias("high"),
        )
    )


def _by_feature(moments: DataFrame, dataset: Sequence[str]) -> tuple[DataFrame, list[str]]:
    keys = [*dataset, "idx"]
    whole = Window.partitionBy(*keys)
    rows = F.sum("rows").over(whole)
    return (
        moments.withColumn("_n", rows)
        .withColumn("_mean", F.sum(F.col("rows") * F.col("mean")).over(whole) / rows)
        .withColumn("_classes", F.count(F.lit(1)).over(whole)),
        keys,
    )


def anova_f(moments: DataFrame, dataset: Sequence[str] = ("dataset",)) -> DataFrame:
    """One-way F per feature; 0 for a constant feature."""
    rows, keys = _by_feature(moments, dataset)
    off = F.col("mean") - F.col("_mean")
    return (
        rows.groupBy(*keys)
        .agg(
            F.sum(F.col("rows") * off * off).alias("_between"),
            F.sum("spread").alias("_within"),
            F.first("_n").alias("_n"),
            F.first("_classes").alias("_c"),
        )
        .select(
            *keys,
            F.when(F.col("_within") > 0, (F.col("_between") / (F.col("_c") - 1)) / (F.col("_within") / (F.col("_n") - F.col("_c"))))
            .when(F.col("_between") > 0, F.lit(MAX_DOUBLE))
            .otherwise(F.lit(0.0))
            .alias("score"),
        )
    )


def chi2(moments: DataFrame, dataset: Sequence[str] = ("dataset",)) -> DataFrame:
    """Chi-squared of per-class value sums against class shares of the total.

    When any training value of a dataset is negative all its features are
    min-max scaled first; the scaled sums follow from sums, counts and ranges.
    """
    rows, keys = _by_feature(moments, dataset)
    feature = Window.partitionBy(*keys)
    spread = F.col("_high") - F.col("_low")
    observed = F.when(F.col("_floor") >= 0, F.col("total")).otherwise(
        F.coalesce(F.try_divide(F.col("total") - F.col("rows") * F.col("_low"), spread), F.lit(0.0))
    )
    return (
        rows.withColumn("_low", F.min("low").over(feature))
        .withColumn("_high", F.max("high").over(feature))
        .withColumn("_floor", F.min("low").over(Window.partitionBy(*dataset)))
        .withColumn("_obs", observed)
        .withColumn("_exp", F.col("rows") / F.col("_n") * F.sum("_obs").over(feature))
        .groupBy(*keys)
        .agg(
            F.coalesce(
                F.sum(F.try_divide((F.col("_obs") - F.col("_exp")) * (F.col("_obs") - F.col("_exp")), F.col("_exp"))),
                F.lit(0.0),
            ).alias("score")
        )
    )


def mutual_info_binned(
    cells: DataFrame,
    class_rows: DataFrame,
    dataset: Sequence[str] = ("dataset",),
    label: str = "target",
    bins: int = 16,
) -> DataFrame:
    """Mutual information (nats) of each feature, in equal-width bins, with the label.

    Exact for 0/1 features; absent cells count as value 0. The cells are read once: all else is made of the number of
    cells with each value, which is one row per class for a bit.
    """
    keys = [*dataset, "idx"]
    counted = stored(cells.groupBy(*keys, label, "x").agg(F.count(F.lit(1)).alias("_c")), "values")
    totals = class_rows.groupBy(*dataset).agg(F.sum("rows").alias("_n"))
    ranges = bounded_side(
        counted.groupBy(*keys)
        .agg(F.min("x").alias("_min"), F.max("x").alias("_max"), F.sum("_c").alias("_k"))
        .join(totals, list(dataset))
        .select(
            *keys,
            "_n",
            F.when(F.col("_k") < F.col("_n"), F.least("_min", F.lit(0.0))).otherwise(F.col("_min")).alias("_low"),
            F.when(F.col("_k") < F.col("_n"), F.greatest("_max", F.lit(0.0))).otherwise(F.col("_max")).alias("_high"),
        ),
        max_rows=200_000,
    )

    def bin_of(x):
        width = F.col("_high") - F.col("_low")
        place = F.floor(F.coalesce(F.try_divide((x - F.col("_low")) * bins, width), F.lit(0.0)))
        return F.least(place, F.lit(bins - 1)).cast("int")

    joint = (
        counted.join(ranges, keys)
        .withColumn("bin", bin_of(F.col("x")))
        .groupBy(*keys, label, "bin")
        .agg(F.sum("_c").alias("_c"))
    )
    absent = (
        ranges.join(class_rows, list(dataset))
        .join(joint.groupBy(*keys, label).agg(F.sum("_c").alias("_seen")), [*keys, label], "left")
        .withColumn("_c", F.col("rows") - F.coalesce("_seen", F.lit(0)))
        .filter(F.col("_c") > 0)
        .withColumn("bin", bin_of(F.lit(0.0)))
        .select(*keys, label, "bin", "_c")
    )
    table = joint.unionByName(absent).groupBy(*keys, label, "bin").agg(F.sum("_c").alias("_c"))
    feature = Window.partitionBy(*keys)
    by_bin, by_class = Window.partitionBy(*keys, "bin"), Window.partitionBy(*keys, label)
    n, c = F.sum("_c").over(feature), F.col("_c")
    term = c / n * F.ln(c * n / (F.sum("_c").over(by_bin) * F.sum("_c").over(by_class)))
    return table.withColumn("_t", term).groupBy(*keys).agg(F.greatest(F.sum("_t"), F.lit(0.0)).alias("score"))


def ranked(scores: DataFrame, group: Sequence[str]) -> DataFrame:
    """Add `place` 1..d by (score desc, idx)."""
    w = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("idx").asc())
    return scores.withColumn("place", F.row_number().over(w))


def top_k(scores: DataFrame, group: Sequence[str], k: int) -> DataFrame:
    """Ordered `features` (array of idx) of the best min(k, d) features per group."""
    best = ranked(scores, group).filter(F.col("place") <= k)
    return best.groupBy(*group).agg(
        F.count(F.lit(1)).alias("K"),
        F.transform(F.array_sort(F.collect_list(F.struct("place", "idx"))), lambda s: s["idx"]).alias("features"),
    )
