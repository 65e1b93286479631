"""Partitioned parquet stores for feature tables, results and predictions."""

from __future__ import annotations

import time
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators import models
from scoreloom.operators.featurize import Family, select_families
from scoreloom.operators.rank import INPUT_ORDER

META = ("dataset", "row_id", "text", "target")


def write_features(df: DataFrame, path: str, families: Sequence[Family], mode: str = "overwrite") -> None:
    """One folder per dataset; one column per family, so a reader scans only the families it needs."""
    have = [c for c in META if c in df.columns]
    rows = df.select(*have, *[f.name for f in families])
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("dataset").parquet(path)


def read_features(
    spark: SparkSession, path: str, families: Sequence[Family], feature_set: str | None = None, dataset: str | None = None
) -> DataFrame:
    """Feature rows of one dataset (or all) with the families of one set (or all)."""
    df = spark.read.parquet(path)
    if dataset is not None:
        df = df.filter(F.col("dataset") == dataset)
    chosen = families if feature_set is None else select_families(families, feature_set)
    meta = [c for c in ("dataset", "row_id", "target") if c in df.columns]
    return df.select(*meta, *[f.name for f in chosen])


def store_index(df: DataFrame, families: Sequence[Family], optional: str = "chargram") -> DataFrame:
    """Rows, columns, feature and class counts per dataset."""
    features = sum(f.size for f in families)
    return df.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("Rows"),
        F.lit(features + 3).alias("Columns"),
        F.lit(features).alias("FeatureCount"),
        F.sum(F.when(F.col("target") == 0, 1).otherwise(0)).alias("Class0"),
        F.sum(F.when(F.col("target") == 1, 1).otherwise(0)).alias("Class1"),
        F.lit(any(f.name == optional for f in families)).alias("HasOptionalFamily"),
    )


def write_results(df: DataFrame, path: str, step: str, mode: str = "overwrite") -> None:
    """A step's result rows under results/step=/Dataset=, with their order: rows are sorted into folders when written.

    Rows that carry an order of input keep it; others get the order of this table, after those of earlier writes.
    """
    if INPUT_ORDER not in df.columns:
        written, zero = F.lit(f"{time.time_ns():020d}"), F.lit(0).cast("long")
        order = F.struct(written.alias("file"), F.monotonically_increasing_id().alias("at"), zero.alias("row"))
        df = df.withColumn(INPUT_ORDER, order)
    rows = df.withColumn("step", F.lit(step)).write.mode(mode).option("partitionOverwriteMode", "dynamic")
    rows.partitionBy("step", "Dataset").parquet(path)


def read_results(spark: SparkSession, path: str, step: str | None = None) -> DataFrame:
    """Result rows with their order."""
    df = spark.read.option("mergeSchema", "true").parquet(path)
    return df if step is None else df.filter(F.col("step") == step)


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """(dataset, experiment, row_id, target, score, prediction) per scored row."""
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("dataset").parquet(path)


def write_model(scorer, path: str) -> None:
    """Save the fitted Spark model behind a scorer."""
    scorer.model.write().overwrite().save(path)


def write_pipeline(scorer, path: str) -> None:
    """Save every fitted step behind a scorer: preprocessing, models, calibration, tables of training rows."""
    scorer.pipeline.write().overwrite().save(path)


def read_pipeline(path: str):
    """The scorer of a saved pipeline."""
    return models.scorer(PipelineModel.load(path))
