"""What the operators of this subpackage share: tables, names, scratch tables, bounded broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.session import scratch_path

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def name(column: str) -> Column:
    """A column by its plain name, whatever characters that has."""
    return F.col("`" + column.replace("`", "``") + "`")


def fresh(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores added until the frame has no such column."""
    have = {c.lower() for c in df.columns}
    while wanted.lower() in have:
        wanted += "_"
    return wanted


def documents(df: DataFrame, *more: str) -> DataFrame:
    """Only doc_id, the text with null as empty, and the columns named; others, clashing names too, are left out."""
    return df.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *more
    )


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared scratch folder and read it there: later steps survive the loss of executors.

    Compressed with zstandard: hashes in hexadecimal take little more than half of what the default codec needs.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_up_to(df: DataFrame, rows: int) -> DataFrame:
    """`df` (stored, so counting is cheap) with a broadcast hint if it has at most `rows` rows; else as it is."""
    return F.broadcast(df) if df.count() <= rows else df
