"""Stratified hold-out and folds with exact, seeded counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.operators.rank import assign_segments


def holdout_sizes(totals: DataFrame, dataset: Sequence[str], label: str, test_size: float) -> DataFrame:
    """Test rows per class: ceil(test_size * n) shared out by largest remainder."""
    whole = Window.partitionBy(*dataset)
    order = whole.orderBy(F.col("_rest").desc(), F.col(label).asc())
    return (
        totals.withColumn("_all", F.sum("n").over(whole))
        .withColumn("_test", F.ceil(F.col("_all") * F.lit(test_size)))
        .withColumn("_floor", F.expr("(n * _test) div _all"))
        .withColumn("_rest", F.expr("(n * _test) % _all"))
        .withColumn("_left", F.col("_test") - F.sum("_floor").over(whole))
        .withColumn("take", F.col("_floor") + (F.row_number().over(order) <= F.col("_left")).cast("bigint"))
        .select(*dataset, label, "n", "take")
    )


def stratified(
    df: DataFrame,
    label: str = "target",
    row_id: str = "row_id",
    test_size: float = 0.2,
    seed: int = 42,
    purpose: str = "split",
    dataset: Sequence[str] = ("dataset",),
    out: str = "split",
    names: tuple[str, str] = ("test", "train"),
) -> DataFrame:
    """Add `out`: names[0] for exactly the held-out share of each class, else names[1]."""
    dataset = list(dataset)
    marked = assign_segments(
        df, [*dataset, label], row_id, seed, purpose,
        lambda totals: holdout_sizes(totals, dataset, label, test_size).select(
            *dataset, label, F.lit(0).alias("segment"), "take"
        ),
        out="_segment",
    )
    return marked.withColumn(out, F.when(F.col("_segment") == 0, names[0]).otherwise(names[1])).drop("_segment")


def nested(train: DataFrame, test_size: float = 0.25, seed: int = 42, **kw) -> DataFrame:
    """Inner validation split of a training set, in column `inner`."""
    return stratified(
        train, test_size=test_size, seed=seed, purpose="inner", out="inner", names=("valid", "fit"), **kw
    )


def kfold(
    df: DataFrame,
    k: int = 3,
    label: str = "target",
    row_id: str = "row_id",
    seed: int = 42,
    purpose: str = "fold",
    dataset: Sequence[str] = ("dataset",),
    out: str = "fold",
) -> DataFrame:
    """Fold 0..k-1; per class the fold sizes differ by at most one."""
    strata = [*dataset, label]

    def takes(totals: DataFrame) -> DataFrame:
        cuts = F.explode(F.array(*[F.lit(i) for i in range(k - 1)])).alias("segment")
        return totals.select(*strata, "n", cuts).select(
            *strata,
            "segment",
            F.expr(f"(segment + 1) * (n div {k}) + least(segment + 1, n % {k})").alias("take"),
        )

    return assign_segments(df, strata, row_id, seed, purpose, takes, out=out)
