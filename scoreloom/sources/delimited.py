"""Delimited text with an unknown separator, and ordered source alternatives."""

from __future__ import annotations

import csv
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.operators.rank import INPUT_ORDER

SEPARATORS = (";", ",")


def _columns(header: str, sep: str) -> list[str]:
    """Names in a header line; none if this separator would cut through a quoted name."""
    fields = next(csv.reader([header], delimiter=sep))
    return [] if any('"' in f for f in fields) else fields


def detect_separator(spark: SparkSession, path: str) -> str:
    """The first separator that splits the header line into more than one column; quoted names stay whole."""
    lines = spark.read.text(path).filter("trim(value) <> ''").limit(1).collect()
    if not lines:
        raise ValueError(f"no header line in {path}")
    header = lines[0][0].lstrip("\ufeff")
    for sep in SEPARATORS:
        if len(_columns(header, sep)) > 1:
            return sep
    raise ValueError(f"no separator found in {path}")


def read_delimited(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[DataFrame, str]:
    """All columns as text, and the separator used. A byte-order mark is dropped, a doubled quote is one.

    Quoted values may hold line ends only with `multi_line`, which reads each file in one task.
    """
    sep = detect_separator(spark, path)
    df = spark.read.csv(path, sep=sep, header=True, inferSchema=False, encoding="UTF-8", escape='"', multiLine=multi_line)
    return df.toDF(*[c.lstrip("\ufeff") for c in df.columns]), sep


def _is_text(path: str) -> bool:
    return path.endswith((".csv", ".txt"))


def in_input_order(df: DataFrame, text: bool, out: str = INPUT_ORDER) -> DataFrame:
    """A fresh scan with column `out`, which sorts rows as they stand: by file, then by place in the file.

    Parquet knows the row of a file. Text knows the block of a file that a task reads, and rows of a block are numbered
    as they are read. Neither depends on how the scan is cut into tasks. A table that brings the column keeps it.
    """
    if out in df.columns:
        return df
    zero = F.lit(0).cast("long")
    place = (F.col("_metadata.file_block_start"), F.monotonically_increasing_id()) if text else (F.col("_metadata.row_index"), zero)
    order = F.struct(F.col("_metadata.file_path").alias("file"), place[0].alias("at"), place[1].alias("row"))
    return df.select("*", order.alias(out))


def read_any(spark: SparkSession, path: str, multi_line: bool = False, ordered: bool = False) -> DataFrame | None:
    """A parquet folder or a delimited file; None when it cannot be read. `ordered` adds the order of input."""
    try:
        df = read_delimited(spark, path, multi_line)[0] if _is_text(path) else spark.read.parquet(path)
    except (PySparkException, Py4JJavaError, ValueError):
        return None
    return in_input_order(df, _is_text(path)) if ordered else df


def _rows(df: DataFrame | None) -> int:
    """Number of rows; 0 for a table that turns out to be broken when it is read."""
    try:
        return 0 if df is None else df.count()
    except (PySparkException, Py4JJavaError):
        return 0


def first_available(
    spark: SparkSession, sources: Mapping[str, Sequence[str]], multi_line: bool = False, ordered: bool = False
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Per step the first readable, non-empty alternative, and a report of what was read.

    `multi_line` and `ordered` are those of `read_any`.
    """
    found: dict[str, DataFrame] = {}
    report = []
    for step, paths in sources.items():
        used, rows, status = paths[0], 0, "MISSING"
        for path in paths:
            df = read_any(spark, path, multi_line, ordered)
            if held := _rows(df):
                found[step] = df
                used, rows, status = path, held, "OK"
                break
        report.append((step, status, used, rows))
    return found, spark.createDataFrame(report, "Step string, Status string, SourceUsed string, Rows bigint")
