"""Exact k-nearest-neighbour classification by pivots, cells and bounded blocks.

Training rows go to the cell of their nearest pivot. Cell radii and the
triangle inequality bound the distance of the k-th neighbour of a query, so a
query is sent only to cells that can still hold one of its neighbours. Cells
and query groups are cut into blocks of bounded size; a task compares one
training block with one query block and returns k rows per query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.functions.hashing import hash_slot, order_key
from scoreloom.functions.numeric import threshold
from scoreloom.session import bounded_side, materialise

MAX_PIVOTS = 1_024
BLOCK_ROWS = 2_048
CHUNK_ROWS = 64
SLACK = 1e-9


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances by plain differences: exact zero for equal rows."""
    out = np.empty((len(a), len(b)))
    for i in range(len(a)):
        diff = b - a[i]
        out[i] = np.sqrt(np.einsum("ij,ij->i", diff, diff))
    return out


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.empty((0, 0))


def k_nearest(
    train: DataFrame,
    queries: DataFrame,
    k: int = 7,
    row_id: str = "row_id",
    values: str = "values",
    label: str = "target",
    seed: int = 42,
    pivots: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query, neighbour, target, distance) of the k nearest training rows of every query."""
    spark = train.sparkSession
    id_type = dict(train.dtypes)[row_id]
    data = train.select(
        F.col(row_id).cast("string").alias("_id"), F.col(row_id).alias("neighbour"), label, values
    )
    if pivots is None:
        pivots = min(MAX_PIVOTS, max(8, math.isqrt(train.count())))
    picked = (
        data.withColumn("_key", order_key(seed, "pivot", "_id")).orderBy("_key", "_id").limit(pivots).collect()
    )
    centres = np.array([r[values] for r in picked], dtype=np.float64)
    shared = spark.sparkContext.broadcast((centres, _distances(centres, centres)))

    def to_cells(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            d = _distances(_matrix(batch[values]), shared.value[0])
            cell = d.argmin(axis=1)
            yield batch.assign(cell=cell.astype("int32"), reach=d[np.arange(len(batch)), cell])

    schema = f"_id string, neighbour {id_type}, {label} int, {values} array<double>, cell int, reach double"
    placed = materialise(
        data.select("_id", "neighbour", F.col(label).cast("int").alias(label), F.col(values).cast("array<double>"))
        .mapInPandas(to_cells, schema)
    )
    # At most pivots rows of k numbers: cell sizes, radii and the k smallest reaches.
    near = Window.partitionBy("cell").orderBy("reach", "_id")
    inner = (
        placed.select("cell", "reach", "_id")
        .withColumn("_at", F.row_number().over(near))
        .filter(F.col("_at") <= k)
        .groupBy("cell")
        .agg(F.sort_array(F.collect_list("reach")).alias("inner"))
    )
    summary = (
        placed.groupBy("cell")
        .agg(F.count(F.lit(1)).alias("n"), F.min("reach").alias("low"), F.max("reach").alias("high"))
        .join(inner, "cell")
        .collect()
    )
    cells = np.array([r["cell"] for r in summary])
    low = np.array([r["low"] for r in summary])
    high = np.array([r["high"] for r in summary])
    blocks = np.array([max(1, -(-r["n"] // block_rows)) for r in summary])
    owner = np.concatenate([np.full(len(r["inner"]), i) for i, r in enumerate(summary)])
    inner_reach = np.concatenate([r["inner"] for r in summary])

    def to_targets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        centres, between = shared.value
        for whole in batches:
            for start in range(0, len(whole), CHUNK_ROWS):
                batch = whole.iloc[start : start + CHUNK_ROWS]
                d = _distances(_matrix(batch[values]), centres)
                d_cells = d[:, cells]
                upper = d_cells[:, owner] + inner_reach
                at = min(k, upper.shape[1]) - 1
                bound = np.partition(upper, at, axis=1)[:, at] * (1 + SLACK) + SLACK
                home = d.argmin(axis=1)
                lower = np.maximum(d_cells - high, low - d_cells)
                gap = between[home][:, cells]
                with np.errstate(divide="ignore", invalid="ignore"):
                    plane = (d_cells**2 - d[np.arange(len(batch)), home][:, None] ** 2) / (2 * gap)
                lower = np.maximum(lower, np.where(gap > 0, plane, 0.0))
                rows, hits = np.nonzero(lower <= bound[:, None])
                out = batch.iloc[rows].reset_index(drop=True)
                yield out.assign(cell=cells[hits].astype("int32"), blocks=blocks[hits].astype("int32"))

    asked = queries.select(F.col(row_id).alias("query"), F.col(values).cast("array<double>").alias(values))
    q_type = dict(asked.dtypes)["query"]
    sent = asked.mapInPandas(to_targets, f"query {q_type}, {values} array<double>, cell int, blocks int")
    sent = sent.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    load = bounded_side(
        sent.groupBy("cell").agg(F.countDistinct("query").alias("_q")).select(
            "cell", F.greatest(F.lit(1), F.ceil(F.col("_q") / block_rows)).cast("int").alias("groups")
        )
    )
    sizes = F.broadcast(
        spark.createDataFrame([(int(c), int(b)) for c, b in zip(cells, blocks)], "cell int, blocks int")
    )
    left = sent.drop("blocks").join(load, "cell").withColumn(
        "part", hash_slot(F.concat_ws(":", F.lit("q"), F.col("query").cast("string")), F.col("groups"))
    ).drop("groups")
    right = (
        placed.join(sizes, "cell")
        .join(load, "cell")
        .withColumn("block", hash_slot(F.concat_ws(":", F.lit("t"), F.col("_id")), F.col("blocks")).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups").cast("bigint") - 1)))
        .drop("groups", "blocks", "reach", "_id")
    )

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "neighbour": [], label: [], "distance": []})
        if not len(a) or not len(b):
            return empty
        b = b.sort_values("neighbour", kind="stable").reset_index(drop=True)
        d = _distances(_matrix(a[values]), _matrix(b[values]))
        best = np.argsort(d, axis=1, kind="stable")[:, :k]
        rows = np.repeat(np.arange(len(a)), best.shape[1])
        cols = best.ravel()
        return pd.DataFrame(
            {
                "query": a["query"].to_numpy()[rows],
                "neighbour": b["neighbour"].to_numpy()[cols],
                label: b[label].to_numpy()[cols],
                "distance": d[rows, cols],
            }
        )

    keys = ["cell", "block", "part"]
    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(compare, f"query {q_type}, neighbour {id_type}, {label} int, distance double")
    )
    w = Window.partitionBy("query").orderBy("distance", "neighbour")
    return found.withColumn("_at", F.row_number().over(w)).filter(F.col("_at") <= k).drop("_at")


def vote(neighbours: DataFrame, label: str = "target") -> DataFrame:
    """Distance-weighted share of class 1; neighbours at distance 0 take all the weight."""
    w = Window.partitionBy("query")
    exact = F.min("distance").over(w) == 0
    weight = F.when(exact, (F.col("distance") == 0).cast("double")).otherwise(F.try_divide(F.lit(1.0), F.col("distance")))
    scored = (
        neighbours.withColumn("_w", weight)
        .groupBy("query")
        .agg((F.sum(F.col("_w") * F.col(label)) / F.sum("_w")).alias("score"))
    )
    return scored.withColumn("prediction", threshold(F.col("score")))


def knn_classify(train: DataFrame, queries: DataFrame, k: int = 7, row_id: str = "row_id", **kw) -> DataFrame:
    """(row_id, score, prediction) for every query row."""
    return vote(k_nearest(train, queries, k, row_id, **kw)).withColumnRenamed("query", row_id)
