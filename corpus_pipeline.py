"""From raw documents to packed training sequences, each stage on all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreloom.llm import mixing, packing, pii, quality_rules, simhash
from scoreloom.llm.common import read, stored
from scoreloom.llm.queries import END_ID, tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates by fingerprint."""
    return simhash.deduplicated(docs, simhash.SHINGLE, simhash.MAX_BITS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by the name of its kind."""
    return pii.redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; at a source's cut, the first words of one."""
    return mixing.resampled(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences."""
    return packing.packed(docs, tokenizer(), END_ID)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
    ("sequences", sequences),
]

#: SQL has no tokenizer; the tests compare the rows with a plain program.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
