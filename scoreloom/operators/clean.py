"""Row cleaning, matrix cleaning and train-fitted column transforms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.numeric import to_class
from scoreloom.session import bounded_side, materialise, stored

#: Values between the brackets of a group that are ordered at last, counted by distinct value.
BRACKETED_ROWS = 2_000_000


def coerce_target(df: DataFrame, raw: str, out: str = "target") -> DataFrame:
    return df.withColumn(out, to_class(F.col(raw)))


def usable_rows(df: DataFrame, target: str = "target", text: str = "text") -> DataFrame:
    """Rows with both target and text."""
    return df.filter(F.col(target).isNotNull() & F.col(text).isNotNull())


def usable_report(
    df: DataFrame, target: str = "target", text: str = "text", dataset: Sequence[str] = ("dataset",)
) -> DataFrame:
    """Kept, dropped and class counts per dataset in one pass."""
    ok = F.col(target).isNotNull() & F.col(text).isNotNull()

    def count(cond):
        return F.sum(F.when(cond, 1).otherwise(0))

    return df.groupBy(*dataset).agg(
        count(ok).alias("kept"),
        count(~ok).alias("dropped"),
        count(ok & (F.col(target) == 0)).alias("class0"),
        count(ok & (F.col(target) == 1)).alias("class1"),
    )


def alignment_report(df: DataFrame, families: Sequence[str], row_id: str = "row_id") -> DataFrame:
    """Per pair of family columns: rows valid in both, and in only one of them."""
    pairs = [(a, b) for i, a in enumerate(families) for b in families[i + 1 :]]

    def count(cond):
        return F.sum(F.when(cond, 1).otherwise(0))

    sums = df.agg(
        *[
            F.struct(
                F.lit(a).alias("family_a"),
                F.lit(b).alias("family_b"),
                count(F.col(a).isNotNull() & F.col(b).isNotNull()).alias("both"),
                count(F.col(a).isNotNull() & F.col(b).isNull()).alias("only_a"),
                count(F.col(a).isNull() & F.col(b).isNotNull()).alias("only_b"),
            ).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return sums.select(F.inline(F.array(*[f"p{i}" for i in range(len(pairs))])))


def require_alignment(df: DataFrame, families: Sequence[str]) -> DataFrame:
    """Rows valid in all families; fails when families disagree on any row."""
    bad = alignment_report(df, families).filter("only_a > 0 or only_b > 0").limit(1).collect()
    if bad:
        raise ValueError(f"families disagree on valid rows: {bad[0].asDict()}")
    return df.filter(F.col(families[0]).isNotNull())


def to_cells(df: DataFrame, values: str, keep: Sequence[str]) -> DataFrame:
    """Array column to one row per (row, feature idx)."""
    return df.select(*keep, F.posexplode(values).alias("idx", "x"))


def exact_median(cells: DataFrame, group: Sequence[str], bracketed: int = BRACKETED_ROWS) -> DataFrame:
    """Exact median of `x` per group (mean of the two middle values), nulls ignored.

    The middle of each group is bracketed by approximate quantiles with a
    guaranteed rank error, and the bracket narrowed until at most `bracketed`
    values, or one repeated value, lie inside; only these are ordered, counted
    per distinct value.
    """
    group = list(group)
    cells = cells.filter(F.col("x").isNotNull()).select(*group, "x")
    state = bounded_side(
        cells.groupBy(*group).agg(
            F.count(F.lit(1)).alias("_n"), F.min("x").alias("_lo"), F.max("x").alias("_hi")
        ).withColumn("_below", F.lit(0).cast("bigint")).withColumn("_in", F.col("_n")),
        max_rows=100_000,
    )
    last = None
    while (most := state.agg(F.max("_in")).first()[0] or 0) > bracketed and most != last:
        last = most
        inside = cells.join(state, group).filter((F.col("x") >= F.col("_lo")) & (F.col("x") <= F.col("_hi")))
        grid = [i / 200 for i in range(201)]
        marks = bounded_side(
            inside.groupBy(*group).agg(
                F.percentile_approx("x", F.array(*[F.lit(g) for g in grid]), F.lit(1000)).alias("_marks")
            ),
            max_rows=100_000,
        )
        step = inside.join(marks, group)
        # Even slots lie between marks, odd slots are the marks themselves, so a
        # value that fills much of the column gets a slot of its own.
        slot = 2 * F.size(F.filter(F.array_distinct("_marks"), lambda m: m < F.col("x"))) + F.array_contains(
            "_marks", F.col("x")
        ).cast("int")
        counted = (
            step.withColumn("_slot", slot)
            .groupBy(*group, "_slot")
            .agg(
                F.count(F.lit(1)).alias("_c"),
                F.min("x").alias("_min"),
                F.max("x").alias("_max"),
                F.first("_n").alias("_n"),
                F.first("_below").alias("_b"),
            )
        )
        run = Window.partitionBy(*group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
        ranked = counted.withColumn("_upto", F.col("_b") + F.sum("_c").over(run))
        lower, upper = F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1")
        hit = ranked.filter((F.col("_upto") >= lower) & (F.col("_upto") - F.col("_c") < upper))
        narrowed = hit.groupBy(*group).agg(
            F.first("_n").alias("_n"),
            F.min("_min").alias("_lo"),
            F.max("_max").alias("_hi"),
            F.min(F.col("_upto") - F.col("_c")).alias("_below"),
            F.sum(F.when(F.col("_min") < F.col("_max"), F.col("_c")).otherwise(0)).alias("_in"),
        )
        state = bounded_side(narrowed, max_rows=100_000)
    counts = (
        cells.join(state, group)
        .filter((F.col("x") >= F.col("_lo")) & (F.col("x") <= F.col("_hi")))
        .groupBy(*group, "x", "_n", "_below")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    run = Window.partitionBy(*group).orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    upto = counts.withColumn("_upto", F.col("_below") + F.sum("_c").over(run))
    first, last = F.expr("(_n + 1) div 2"), F.expr("_n div 2 + 1")
    lies = lambda at: F.max(
        F.when((F.col("_upto") >= at) & (F.col("_upto") - F.col("_c") < at), F.col("x"))
    )
    return upto.groupBy(*group).agg(((lies(first) + lies(last)) / 2).alias("median"))


def sparse_median(
    cells: DataFrame, sizes: DataFrame, group: Sequence[str] = ("dataset",), bracketed: int = BRACKETED_ROWS
) -> DataFrame:
    """(group, idx, median) from stored cells (group, idx, x) and the rows of each group (group, n).

    Cells that are not stored are 0, those with a null are missing. Where the two middle values lie among zeros, or among
    negative or positive cells that are all equal, their counts say what they are and nothing is ordered; that is every
    bit, however many rows have it. Only the cells and zeros of other features are written out, once. A feature without
    any stored cell is not in the result (its median is 0), one that is always missing has a null.
    """
    group = list(group)
    x = F.col("x")
    count = lambda cond: F.sum(cond.cast("long"))
    ends = [end(F.when(side, x)).alias(name) for name, end, side in (
        ("_neg_min", F.min, x < 0), ("_neg_max", F.max, x < 0), ("_pos_min", F.min, x > 0), ("_pos_max", F.max, x > 0))]
    held = cells.groupBy(*group, "idx").agg(
        count(x < 0).alias("_neg"), count(x > 0).alias("_pos"), count(x == 0).alias("_zero"), count(x.isNull()).alias("_null"), *ends
    )
    held = held.fillna(0, ["_neg", "_pos", "_zero"]).join(sizes.select(*group, F.col("n").alias("_rows")), group)
    held = held.withColumn("_n", F.col("_rows") - F.col("_null"))
    held = held.withColumn("_zeros", F.col("_n") - F.col("_neg") - F.col("_pos"))

    def lies(rank):
        """The value at a rank, if the counts tell it."""
        negative = F.when(F.col("_neg_min") == F.col("_neg_max"), F.col("_neg_min"))
        positive = F.when(F.col("_pos_min") == F.col("_pos_max"), F.col("_pos_min"))
        return F.when(rank <= F.col("_neg"), negative).when(rank <= F.col("_neg") + F.col("_zeros"), 0.0).otherwise(positive)

    middle = (lies(F.expr("(_n + 1) div 2")) + lies(F.expr("_n div 2 + 1"))) / 2
    held = stored(held.withColumn("median", F.when(F.col("_n") > 0, middle)), "cells")
    known = held.filter(F.col("median").isNotNull() | (F.col("_n") == 0)).select(*group, "idx", "median")
    open_ = held.filter(F.col("median").isNull() & (F.col("_n") > 0))
    values = cells.filter(x.isNotNull()).join(open_.select(*group, "idx"), [*group, "idx"]).select(*group, "idx", x.cast("double").alias("x"))
    absent = open_.filter("_zeros > _zero").select(*group, "idx", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_zeros") - F.col("_zero"))).alias("x"))
    every = stored(values.unionByName(absent.withColumn("x", F.lit(0.0))), "open")
    return known.unionByName(exact_median(every, [*group, "idx"], bracketed))


def filled(rows: DataFrame, values: str, policy: str = "zero", train: DataFrame | None = None, dataset: Sequence[str] = ("dataset",)) -> DataFrame:
    """Array column `values` without nulls, NaN and infinities: 0, or with policy `median` that of the training rows.

    A feature that no training row has is 0 there too.
    """
    clean = lambda v: F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v)
    rows = rows.withColumn(values, F.transform(values, lambda v: clean(v.cast("double"))))
    if policy == "zero":
        return rows.withColumn(values, F.transform(values, lambda v: F.coalesce(v, F.lit(0.0))))
    if policy != "median":
        raise ValueError(f"unknown policy: {policy}")
    known = train.withColumn(values, F.transform(values, lambda v: clean(v.cast("double"))))
    medians = fit_median(known, values, dataset)
    out = rows.join(bounded_side(medians), list(dataset))
    return out.withColumn(values, F.zip_with(values, "medians", lambda v, m: F.coalesce(v, m, F.lit(0.0)))).drop("medians")


def fit_median(
    train: DataFrame, values: str, dataset: Sequence[str] = ("dataset",), bracketed: int = BRACKETED_ROWS
) -> DataFrame:
    """(dataset, medians array) over training rows; an all-null feature has a null entry."""
    dataset = list(dataset)
    cells = to_cells(train, values, dataset)
    medians = exact_median(cells, [*dataset, "idx"], bracketed)
    widths = train.groupBy(*dataset).agg(F.max(F.size(values)).alias("_width"))
    known = medians.groupBy(*dataset).agg(F.map_from_entries(F.collect_list(F.struct("idx", "median"))).alias("_m"))
    return widths.join(known, dataset, "left").select(
        *dataset,
        F.expr("transform(sequence(0, _width - 1), i -> try_element_at(_m, i))").alias("medians"),
    )


def apply_median(df: DataFrame, values: str, medians: DataFrame, dataset: Sequence[str] = ("dataset",)) -> DataFrame:
    """Fill nulls from `medians`; features without a median are dropped."""
    filled = df.join(bounded_side(medians), list(dataset)).withColumn(
        values, F.zip_with(values, "medians", lambda v, m: F.when(m.isNotNull(), F.coalesce(v, m)))
    )
    return filled.withColumn(values, F.array_compact(values)).drop("medians")


def column_moments(train: DataFrame, values: str, dataset: Sequence[str] = ("dataset",)) -> DataFrame:
    """Mean, population variance, min and max of every array position over training rows."""
    return (
        to_cells(train, values, dataset)
        .groupBy(*dataset, "idx")
        .agg(
            F.avg("x").alias("mean"),
            F.var_pop("x").alias("variance"),
            F.min("x").alias("low"),
            F.max("x").alias("high"),
        )
    )


def rescale(
    df: DataFrame, values: str, moments: DataFrame, how: str = "standard", dataset: Sequence[str] = ("dataset",)
) -> DataFrame:
    """Zero-variance filter, then `standard` ((x - mean) / std) or `minmax` scaling of filled arrays.

    One array of parameters per dataset, as wide as the row itself, is joined;
    rows are not exploded.
    """
    dataset = list(dataset)
    params = moments.groupBy(*dataset).agg(
        F.array_sort(F.collect_list(F.struct("idx", "mean", "variance", "low", "high"))).alias("_params")
    )

    def scaled(x, p):
        if how == "standard":
            y = (x - p["mean"]) / F.sqrt(p["variance"])
        elif how == "minmax":
            y = (x - p["low"]) / (p["high"] - p["low"])
        else:
            raise ValueError(f"unknown scaling: {how}")
        return F.when(p["variance"] > 0, y)

    out = df.join(bounded_side(params), dataset).withColumn(values, F.zip_with(values, "_params", scaled))
    return out.withColumn(values, F.array_compact(values)).drop("_params")
