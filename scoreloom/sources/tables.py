"""The given tables as labelled datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, text) of every document."""
    return spread(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), "text"), "row_id")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, text, quality, toxic) of documents that have labels."""
    docs = documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_id"), "quality", "toxic")
    return docs.join(labels, "row_id")


def by_target(df: DataFrame) -> DataFrame:
    """Two datasets from two label columns: (dataset, ..., target)."""
    rest = [c for c in df.columns if c not in ("quality", "toxic")]
    return df.select(
        *rest,
        F.inline(
            F.array(
                F.struct(F.lit("quality").alias("dataset"), F.col("quality").alias("target")),
                F.struct(F.lit("toxic").alias("dataset"), F.col("toxic").alias("target")),
            )
        ),
    )


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(dataset, row_id, target, values) from the embeddings table; class 1 is label < 3."""
    return table(spark, sf_dir, "embeddings").select(
        F.lit("vectors").alias("dataset"),
        F.col("vec_id").alias("row_id"),
        (F.col("label") < 3).cast("int").alias("target"),
        F.col("embedding").cast("array<double>").alias("values"),
    )
