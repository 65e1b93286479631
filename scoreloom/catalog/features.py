"""Text features: hashed bits, key bits, descriptors, assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from scoreloom.catalog import common as C
from scoreloom.catalog import sql as S
from scoreloom.catalog.registry import query
from scoreloom.functions.text import DESCRIPTOR_NAMES
from scoreloom.operators import featurize


def _bits_sql(block: str) -> str:
    return (
        S.ctes(block)
        + "SELECT t.row_id, count(b.bit) AS n_bits, CAST(coalesce(sum(b.bit), 0) AS BIGINT) AS bit_sum,"
        f" md5(coalesce(string_agg(CAST(b.bit AS VARCHAR), ',' ORDER BY b.bit), '')) AS bits_md5"
        f" FROM tok t LEFT JOIN {block} b ON b.row_id = t.row_id WHERE len(t.t) > 0 GROUP BY t.row_id"
    )


def _bits(spark, sf, name):
    docs = featurize.featurize(C.valid_documents(spark, sf), C.family(name))
    return docs.select(
        "row_id",
        F.size(name).cast("bigint").alias("n_bits"),
        F.aggregate(name, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("bit_sum"),
        F.md5(F.array_join(F.transform(name, lambda b: b.cast("string")), ",")).alias("bits_md5"),
    )


@query("hashed_ngram_bits", _bits_sql("ngram"))
def hashed_ngram_bits(spark, sf):
    return _bits(spark, sf, "ngram")


@query("char_ngram_bits", _bits_sql("chargram"))
def char_ngram_bits(spark, sf):
    return _bits(spark, sf, "chargram")


@query("pattern_key_bits", _bits_sql("keys"))
def pattern_key_bits(spark, sf):
    return _bits(spark, sf, "keys")


@query("scalar_descriptors", S.ctes("wide") + f"SELECT row_id, {S.rounded(*DESCRIPTOR_NAMES)} FROM wide")
def scalar_descriptors(spark, sf):
    docs = featurize.featurize(C.valid_documents(spark, sf), C.family("desc"))
    return docs.select(
        "row_id", *[F.round(F.get("desc", F.lit(i)), 6).alias(n) for i, n in enumerate(DESCRIPTOR_NAMES)]
    )


@query(
    "feature_assemble",
    S.ctes("doc_cells")
    + "SELECT row_id, count(*) AS nonzero, round(sum(x), 4) AS total, CAST(sum(idx) AS BIGINT) AS idx_sum FROM doc_cells WHERE x <> 0 GROUP BY row_id",
)
def feature_assemble(spark, sf):
    """All four families in one vector per document, in table order."""
    docs = featurize.featurize(C.valid_documents(spark, sf), C.FAMILIES)
    rows = docs.select("row_id", featurize.sparse_vector(C.FAMILIES).alias("v"))
    return rows.select(
        "row_id",
        F.size("v.indices").cast("bigint").alias("nonzero"),
        F.round(F.aggregate("v.values", F.lit(0.0), lambda a, x: a + x), 4).alias("total"),
        F.aggregate("v.indices", F.lit(0).cast("bigint"), lambda a, i: a + i).alias("idx_sum"),
    )


def _vowel_shares():
    """Shares of five vowels among the letters of a text; a text without letters is invalid."""

    def shares(text: str):
        letters = [c for c in text.lower() if c.isascii() and c.isalpha()]
        return [letters.count(v) / len(letters) for v in "aeiou"] if letters else None

    return shares


@query(
    "custom_featurizer",
    "WITH c AS (SELECT doc_id AS row_id, regexp_replace(text, '[^A-Za-z]', '', 'g') AS t FROM documents)\n"
    "SELECT row_id, " + ", ".join(
        f"round((length(t) - length(regexp_replace(t, '[{v}{v.upper()}]', '', 'g'))) / CAST(length(t) AS DOUBLE), 6) AS {v}_share" for v in "aeiou"
    )
    + " FROM c WHERE length(t) > 0",
)
def custom_featurizer(spark, sf):
    rows = featurize.custom_featurizer(C.documents(spark, sf), _vowel_shares).filter(F.col("values").isNotNull())
    return rows.select("row_id", *[F.round(F.get("values", F.lit(i)), 6).alias(f"{v}_share") for i, v in enumerate("aeiou")])
