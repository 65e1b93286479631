"""Class resampling of training rows to a positive/negative ratio, and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.hashing import hash_slot, order_key
from scoreloom.operators.rank import assign_segments, exact_rank
from scoreloom.session import bounded_side

# Scenario name, positive/negative ratio, method.
SCENARIOS: tuple[tuple[str, float, str], ...] = (
    ("none", 1.0, "none"),
    ("balanced_oversampling", 1.0, "oversampling"),
    ("balanced_undersampling", 1.0, "undersampling"),
    ("positive_5x_oversampling", 5.0, "oversampling"),
    ("negative_5x_oversampling", 0.2, "oversampling"),
    ("positive_5x_undersampling", 5.0, "undersampling"),
    ("negative_5x_undersampling", 0.2, "undersampling"),
)

SLOTS_PER_TASK = 100_000


def class_distribution(df: DataFrame, dataset: Sequence[str] = ("dataset",), label: str = "target") -> DataFrame:
    return df.groupBy(*dataset, label).agg(F.count(F.lit(1)).alias("rows"))


def wanted_rows(label: Column, pos: Column, neg: Column, ratio: float, method: str) -> Column:
    """Rows of this class after resampling to `ratio` = positives / negatives."""
    r = F.lit(float(ratio))
    own = F.when(label == 1, pos).otherwise(neg)
    short = F.coalesce(F.try_divide(pos, neg) < r, F.lit(False))
    both = (pos > 0) & (neg > 0)  # a single class is left as it is
    if method == "none":
        return own.cast("bigint")
    if method == "oversampling":
        grown = F.when(short & (label == 1), F.ceil(r * neg)).when(~short & (label == 0), F.ceil(pos / r))
        return F.coalesce(F.when(both, grown), own).cast("bigint")
    if method == "undersampling":
        kept = F.when(short & (label == 0), F.least(neg, F.greatest(F.lit(5), F.floor(pos / r)))).when(
            ~short & (label == 1), F.least(pos, F.greatest(F.lit(5), F.floor(r * neg)))
        )
        return F.coalesce(F.when(both, kept), own).cast("bigint")
    raise ValueError(f"unknown resampling method: {method}")


def resample_plan(
    counts: DataFrame, ratio: float, method: str, dataset: Sequence[str] = ("dataset",), label: str = "target",
    rows: str = "rows",
) -> DataFrame:
    """(dataset, class, rows) to (dataset, class, rows, wanted)."""
    whole = Window.partitionBy(*dataset)
    pos = F.sum(F.when(F.col(label) == 1, F.col(rows)).otherwise(0)).over(whole)
    neg = F.sum(F.when(F.col(label) == 0, F.col(rows)).otherwise(0)).over(whole)
    return (
        counts.withColumn("_pos", pos)
        .withColumn("_neg", neg)
        .withColumn("wanted", wanted_rows(F.col(label), F.col("_pos"), F.col("_neg"), ratio, method))
        .drop("_pos", "_neg")
    )


def _slots(plan: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per draw 0..wanted-1, spread over tasks before the long explode."""
    chunks = plan.select(
        *keys, "rows", "wanted", F.explode(F.expr(f"sequence(0L, (wanted - 1) div {SLOTS_PER_TASK})")).alias("_chunk")
    ).repartition(*keys, "_chunk")
    return chunks.select(
        *keys,
        "rows",
        F.explode(
            F.expr(f"sequence(_chunk * {SLOTS_PER_TASK}, least((_chunk + 1) * {SLOTS_PER_TASK}, wanted) - 1)")
        ).alias("_slot"),
    )


def to_ratio(
    train: DataFrame,
    ratio: float,
    method: str,
    label: str = "target",
    row_id: str = "row_id",
    seed: int = 42,
    dataset: Sequence[str] = ("dataset",),
) -> DataFrame:
    """Resampled training rows; a repeated row keeps its id and gets `copy_no` 1, 2, ..."""
    keys = [*dataset, label]
    whole = train.withColumn("copy_no", F.lit(1).cast("bigint"))
    if method == "none":
        return whole
    plan = resample_plan(class_distribution(train, dataset, label), ratio, method, dataset, label)
    if method == "undersampling":
        marked = assign_segments(
            train, keys, row_id, seed, "under",
            lambda totals: resample_plan(totals, ratio, method, dataset, label, rows="n").select(
                *keys, F.lit(0).alias("segment"), F.col("wanted").alias("take")
            ),
            out="_segment",
        )
        kept = marked.filter(F.col("_segment") == 0).drop("_segment")
        return kept.withColumn("copy_no", F.lit(1).cast("bigint"))

    plan = bounded_side(plan)
    grown = plan.filter(F.col("wanted") > F.col("rows")).select(*keys, "rows", "wanted")
    kept = whole.join(plan.filter(F.col("wanted") <= F.col("rows")).select(*keys), keys, "left_semi")
    draw_text = F.concat_ws(":", F.lit(str(seed)), F.lit("over"), F.col(label), F.col("_slot"))
    draws = (
        _slots(grown, keys)
        .select(*keys, (hash_slot(draw_text, F.col("rows")) + 1).alias("_rank"))
        .groupBy(*keys, "_rank")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    ranked = exact_rank(
        train.join(grown.select(*keys), keys, "left_semi").withColumn(
            "_key", order_key(seed, "over", row_id)
        ),
        keys, "_key", row_id, out="_rank",
    )
    # There are as many draws as output rows, which no size estimate sees through
    # the explode: the hint keeps the planner from broadcasting them.
    repeated = (
        ranked.join(draws.hint("merge"), [*keys, "_rank"])
        .withColumn("copy_no", F.explode(F.expr("sequence(1L, _copies)")))
        .select(*train.columns, "copy_no")
    )
    return kept.unionByName(repeated)


def class_weights(counts: DataFrame, dataset: Sequence[str] = ("dataset",), label: str = "target") -> DataFrame:
    """Balanced weights n / (classes * n_class) from class counts."""
    whole = Window.partitionBy(*dataset)
    n, classes = F.sum("rows").over(whole), F.count(F.lit(1)).over(whole)
    return counts.select(*dataset, label, "rows", (n / (classes * F.col("rows"))).alias("weight"))


def scenario_counts(
    train: DataFrame, dataset: Sequence[str] = ("dataset",), label: str = "target"
) -> DataFrame:
    """Class counts of every scenario, from the class counts alone."""
    counts = class_distribution(train, dataset, label)
    parts = [
        resample_plan(counts, ratio, method, dataset, label).select(
            *dataset,
            F.lit(name).alias("SamplingScenario"),
            F.lit(method).alias("SamplingMethod"),
            F.lit(ratio).alias("SamplingRatio"),
            label,
            "wanted",
        )
        for name, ratio, method in SCENARIOS
    ]
    table = parts[0]
    for part in parts[1:]:
        table = table.unionByName(part)
    return (
        table.groupBy(*dataset, "SamplingScenario", "SamplingMethod", "SamplingRatio")
        .agg(
            F.sum(F.when(F.col(label) == 0, F.col("wanted")).otherwise(0)).alias("TrainClass0_after_sampling"),
            F.sum(F.when(F.col(label) == 1, F.col("wanted")).otherwise(0)).alias("TrainClass1_after_sampling"),
        )
    )
