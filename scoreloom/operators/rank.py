"""Exact ranks and order statistics for groups too large for one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.hashing import order_key
from scoreloom.session import bounded_side, materialise, stored

PREFIX_DIGITS = 4  # 16**4 key prefixes per group

#: Where a row stood in the files it was read from; carried along to settle ties.
INPUT_ORDER = "InputOrder"


def exact_rank(
    df: DataFrame, group: Sequence[str], key: str, tie: str, out: str = "rank", digits: int = PREFIX_DIGITS
) -> DataFrame:
    """1..n by (key, tie) inside each group, for md5-shaped keys.

    A group is cut by key prefix. Prefix counts give each prefix its offset, so
    one task sorts one prefix of one group, never a whole group. The window and
    the offset join share one partitioning: a single shuffle of the rows.
    """
    group = list(group)
    rows = df.withColumn("_prefix", F.substring(F.col(key), 1, digits))
    sizes = rows.groupBy(*group, "_prefix").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy(*group).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, "_prefix", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*group, "_prefix").orderBy(key, tie)
    return (
        rows.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, [*group, "_prefix"])
        .withColumn(out, F.col("_before") + F.col("_inside"))
        .drop("_prefix", "_before", "_inside")
    )


def assign_segments(
    df: DataFrame,
    strata: Sequence[str],
    row_id: str,
    seed: int,
    purpose: str,
    takes: Callable[[DataFrame], DataFrame],
    out: str = "segment",
    digits: int = PREFIX_DIGITS,
) -> DataFrame:
    """Cut every stratum, in seeded order, into consecutive segments of exact size.

    Rows of each prefix are counted once, for the totals and the cuts.

    `takes` maps (strata..., n) to (strata..., segment, take): `take` rows of
    the stratum lie in segments 0..segment. The cuts are found first: only
    prefix counts and the rows of the few prefixes that hold a cut are shuffled.
    The data itself never moves, each row is compared with the cuts of its stratum.
    A row with a null in a stratum column is an error: it is in no stratum.
    """
    strata = list(strata)
    key = order_key(seed, purpose, row_id)
    keyed = df.select(*strata, F.col(row_id).alias("_row"), key.alias("_key"))
    prefixed = keyed.withColumn("_prefix", F.substring("_key", 1, digits))
    counted = stored(prefixed.groupBy(*strata, "_prefix").agg(F.count(F.lit(1)).alias("_size")), "prefixes")
    totals = bounded_side(counted.groupBy(*strata).agg(F.sum("_size").alias("n")))
    wanted = takes(totals).select(*strata, F.col("take").cast("bigint").alias("_rank"))
    running = Window.partitionBy(*strata).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    ladder = counted.withColumn("_upto", F.sum("_size").over(running))
    edges = bounded_side(
        wanted.join(ladder, strata)
        .filter((F.col("_rank") > F.col("_upto") - F.col("_size")) & (F.col("_rank") <= F.col("_upto")))
        .select(*strata, "_prefix", (F.col("_upto") - F.col("_size")).alias("_before"))
        .distinct()
    )
    order = Window.partitionBy(*strata, "_prefix").orderBy("_key", "_row")
    placed = prefixed.join(edges, [*strata, "_prefix"]).withColumn("_rank", F.col("_before") + F.row_number().over(order))
    found = placed.join(wanted, [*strata, "_rank"]).select(*strata, "_key", "_row")
    nothing = wanted.filter(F.col("_rank") == 0).select(
        *strata, F.lit("").alias("_key"), F.lit(None).cast(dict(keyed.dtypes)["_row"]).alias("_row")
    )
    cuts = bounded_side(
        found.unionByName(nothing).groupBy(*strata).agg(F.collect_list(F.struct("_key", "_row")).alias("_cuts"))
    )
    mark = F.struct(F.col("_key"), F.col(row_id).alias("_row"))
    nowhere = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in strata])
    segment = F.coalesce(F.size(F.filter("_cuts", lambda c: c < mark)), F.lit(0))
    return (
        df.withColumn("_key", key)
        .join(cuts, strata, "left")
        .withColumn(out, F.when(nowhere, F.raise_error(F.lit(f"null in {strata}")).cast("int")).otherwise(segment))
        .drop("_key", "_cuts")
    )


def running_totals(
    df: DataFrame, group: Sequence[str], order: str, measures: Sequence[str], prefix: str = "cum_"
) -> DataFrame:
    """Running sums by descending `order` inside each group, whatever its size.

    Rows are range-partitioned by (group, order) and written once with their
    partition number. Partition sums give offsets, so a group spread over many
    partitions is summed by many tasks. `order` must be unique within a group.
    """
    group = list(group)
    placed = materialise(
        df.repartitionByRange(*[F.col(g) for g in group], F.col(order).desc()).withColumn(
            "_part", F.spark_partition_id()
        )
    )
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(*group, "_part")
        .agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
        .select(
            *group, "_part", *[F.coalesce(F.sum(f"_sum_{m}").over(before), F.lit(0)).alias(f"_off_{m}") for m in measures]
        )
    )
    inside = (
        Window.partitionBy(*group, "_part").orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, 0)
    )
    summed = placed.select("*", *[F.sum(m).over(inside).alias(f"_in_{m}") for m in measures])
    joined = summed.join(offsets, [*group, "_part"])
    return joined.select(
        *df.columns, *[(F.col(f"_in_{m}") + F.col(f"_off_{m}")).alias(f"{prefix}{m}") for m in measures]
    )


def best_per_group(
    df: DataFrame, group: Sequence[str], metric: str = "ROC", ordinal: str | None = None, keep: int = 1
) -> DataFrame:
    """Top rows by metric, nulls last; ties go to the smaller `ordinal`.

    Without one that is the order of input, if the rows carry it, else the values of all other columns, so that equal
    input gives equal output.
    """
    if ordinal is None:
        others = [f"`{c}`" for c, kind in df.dtypes if c not in (*group, metric) and not kind.startswith("map")]
        ties = [INPUT_ORDER] if INPUT_ORDER in df.columns else others
    else:
        ties = [ordinal]
    w = Window.partitionBy(*group).orderBy(F.col(metric).desc_nulls_last(), *[F.col(c).asc() for c in ties])
    return df.withColumn("_place", F.row_number().over(w)).filter(F.col("_place") <= keep).drop("_place")


def candidate_rank(
    df: DataFrame, group: Sequence[str], metric: str, ordinal: str, out: str = "CandidateRank"
) -> DataFrame:
    """1..n by metric inside each group of a result table."""
    w = Window.partitionBy(*group).orderBy(F.col(metric).desc_nulls_last(), F.col(ordinal).asc())
    return df.withColumn(out, F.row_number().over(w))
