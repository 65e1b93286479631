"""Shared inputs of the registered queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions.numeric import threshold
from scoreloom.functions.text import DESCRIPTOR_NAMES, has_token
from scoreloom.operators import featurize, split
from scoreloom.session import bounded_side, stored
from scoreloom.sources.tables import by_target, documents, labelled_documents, table  # noqa: F401

FAMILIES = featurize.text_families()


def family(*names: str) -> list[featurize.Family]:
    return [f for f in FAMILIES if f.name in names]


def labelled(spark: SparkSession, sf: str, *names: str) -> DataFrame:
    """(dataset, row_id, target, families...) of the two labelled datasets.

    Every caller reads the rows several times (cuts, fit, score), so the
    features are written once; invalid texts have null families.
    """
    docs = labelled_documents(spark, sf)
    return by_target(stored(featurize.featurize(docs, family(*names)).drop("text"), "features"))


def valid_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with at least one token; checked on the text before features are made."""
    return documents(spark, sf).filter(has_token(F.col("text")))


def pool(spark: SparkSession, sf: str) -> DataFrame:
    """(dataset, row_id, target): labelled documents and all events."""
    docs = by_target(labelled_documents(spark, sf).select("row_id", "quality", "toxic"))
    events = table(spark, sf, "events").select(
        F.lit("events").alias("dataset"),
        F.col("event_id").alias("row_id"),
        (F.col("event_type") == "error").cast("int").alias("target"),
    )
    columns = ["dataset", "row_id", "target"]
    return docs.select(*columns).unionByName(events.select(*columns))


def train_pool(spark: SparkSession, sf: str) -> DataFrame:
    return split.stratified(pool(spark, sf)).filter(F.col("split") == "train").drop("split")


def train_rows(df: DataFrame) -> DataFrame:
    return split.stratified(df).filter(F.col("split") == "train").drop("split")


def univariate_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Every descriptor as a scorer, min-max scaled on training rows: (dataset, row_id, target, split, view, score)."""
    rows = split.stratified(labelled(spark, sf, "desc"))
    cells = rows.select("dataset", "row_id", "target", "split", F.posexplode("desc").alias("view", "x"))
    limits = bounded_side(
        cells.filter(F.col("split") == "train").groupBy("dataset", "view").agg(F.min("x").alias("_lo"), F.max("x").alias("_hi"))
    )
    width = F.col("_hi") - F.col("_lo")
    return cells.join(limits, ["dataset", "view"]).select(
        "dataset", "row_id", "target", "split", "view",
        F.coalesce(F.try_divide(F.col("x") - F.col("_lo"), width), F.lit(0.0)).alias("score"),
    )


def view_name(view: Column) -> Column:
    names = F.array(*[F.lit(n) for n in DESCRIPTOR_NAMES])
    return F.get(names, view.cast("int"))


def with_prediction(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", threshold(F.col("score")))


def line_scores(spark: SparkSession, sf: str, *views: str) -> DataFrame:
    """Line items as predictions of a return: one experiment per numeric column and line status."""
    scales = {"quantity": ("l_quantity", 50.0), "discount": ("l_discount", 0.1), "tax": ("l_tax", 0.08), "price": ("l_extendedprice", 100000.0)}
    lines = table(spark, sf, "lineitem")
    pairs = F.array(
        *[F.struct(F.lit(v).alias("experiment"), (F.col(scales[v][0]) / scales[v][1]).alias("score")) for v in views]
    )
    rows = lines.select(
        F.col("l_linestatus").alias("dataset"), (F.col("l_returnflag") == "R").cast("int").alias("target"), F.inline(pairs)
    )
    return with_prediction(rows)


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return reduce(lambda d, n: d.withColumn(n, F.round(F.col(f"`{n}`"), digits)), names, df)
