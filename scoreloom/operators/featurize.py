"""Feature families, their manifest, and assembly into model input."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloom.functions import text as T


@dataclass(frozen=True)
class Family:
    """A block of features held in one column.

    `bits` families store the sorted positions of their ones (array<int>),
    `dense` families store every value (array<double>).
    """

    name: str
    kind: str
    names: tuple[str, ...]
    build: Callable[[Column], Column] | None = None

    @property
    def size(self) -> int:
        return len(self.names)


def text_families(bits: int = 1024, patterns: Sequence[str] = T.KEY_PATTERNS) -> tuple[Family, ...]:
    """The four text families in table order."""
    return (
        Family("ngram", "bits", tuple(f"ngram_{i}" for i in range(bits)), lambda c: T.ngram_bits(c, bits=bits)),
        Family("keys", "bits", tuple(f"keys_{i + 1}" for i in range(len(patterns))), lambda c: T.key_bits(c, patterns)),
        Family("desc", "dense", tuple(f"desc_{n}" for n in T.DESCRIPTOR_NAMES), T.descriptors),
        Family("chargram", "bits", tuple(f"chargram_{i}" for i in range(bits)), lambda c: T.chargram_bits(c, bits=bits)),
    )


# Feature sets in reporting order, and the families each one takes.
FEATURE_SETS: Mapping[str, tuple[str, ...]] = {
    "desc": ("desc",),
    "ngram": ("ngram",),
    "keys": ("keys",),
    "chargram": ("chargram",),
    "keys_desc": ("keys", "desc"),
    "ngram_desc": ("ngram", "desc"),
    "chargram_desc": ("chargram", "desc"),
    "keys_ngram": ("keys", "ngram"),
    "keys_chargram": ("keys", "chargram"),
    "all_available": ("ngram", "keys", "desc", "chargram"),
}


def available_sets(families: Sequence[Family], sets: Mapping[str, tuple[str, ...]] = FEATURE_SETS) -> list[str]:
    """Sets with at least one family present; a set made only of missing families is left out."""
    have = {f.name for f in families}
    return [name for name, wanted in sets.items() if have & set(wanted)]


def select_families(
    families: Sequence[Family], feature_set: str, sets: Mapping[str, tuple[str, ...]] = FEATURE_SETS
) -> list[Family]:
    """Families of a set, in table order; fails when none is present."""
    chosen = [f for f in families if f.name in sets[feature_set]]
    if not chosen:
        raise ValueError(f"no feature columns for {feature_set}")
    return chosen


def featurize(df: DataFrame, families: Sequence[Family], text: str = "text") -> DataFrame:
    """Add one column per family, all in one projection over the row's text."""
    return df.withColumns({f.name: f.build(F.col(text)) for f in families if f.build})


def manifest(spark: SparkSession, families: Sequence[Family]) -> DataFrame:
    """(family, idx, feature) in table order; idx counts over all families."""
    rows, at = [], 0
    for f in families:
        rows += [(f.name, at + i, n) for i, n in enumerate(f.names)]
        at += f.size
    return spark.createDataFrame(rows, "family string, idx int, feature string")


def sparse_cells(df: DataFrame, families: Sequence[Family], keep: Sequence[str]) -> DataFrame:
    """(keep..., idx, x) of all stored cells; idx counts over `families`.

    Each family is read and spread out by itself, so no array of cells is built; a row that lacks a family has no cells.
    """
    whole = df.filter(reduce(lambda a, b: a & b, [F.col(f.name).isNotNull() for f in families]))
    parts, at = [], 0
    for f in families:
        if f.kind == "bits":
            cells = whole.select(*keep, F.explode(f.name).alias("_bit")).withColumn("_x", F.lit(1.0))
        else:
            cells = whole.select(*keep, F.posexplode(f.name).alias("_bit", "_x"))
        parts.append(cells.select(*keep, (F.col("_bit") + at).cast("int").alias("idx"), F.col("_x").cast("double").alias("x")))
        at += f.size
    return reduce(DataFrame.unionByName, parts)


def sparse_vector(families: Sequence[Family]) -> Column:
    """What a sparse vector over `families` is made of; `session.stored` with `vectors` reads it back as one.

    Only cells other than 0 are written, and no family is spread out on the way.
    """
    indices, values, at = [], [], 0
    for f in families:
        if f.kind == "bits":
            indices.append(F.transform(F.sort_array(f.name), lambda b: (b + at).cast("int")))
            values.append(F.when(F.col(f.name).isNotNull(), F.array_repeat(F.lit(1.0), F.size(f.name))))
        else:
            dense = F.transform(f.name, lambda v: v.cast("double"))
            indices.append(F.array_compact(F.transform(dense, lambda v, i: F.when(v != 0, (i + at).cast("int")))))
            values.append(F.filter(dense, lambda v: v != 0))
        at += f.size
    return F.struct(
        F.lit(0).cast("byte").alias("type"), F.lit(at).alias("size"), F.concat(*indices).alias("indices"), F.concat(*values).alias("values")
    )


def joined(df: DataFrame, families: Sequence[Family], out: str = "features") -> DataFrame:
    """One vector column from columns that hold each family's vector; sizes come from the families, so no row is read for them."""
    for f in families:
        df = VectorSizeHint(inputCol=f.name, size=f.size, handleInvalid="optimistic").transform(df)
    return VectorAssembler(inputCols=[f.name for f in families], outputCol=out, handleInvalid="keep").transform(df)


def assemble(df: DataFrame, families: Sequence[Family], out: str = "features") -> DataFrame:
    """One vector column from the family columns; bit families stay sparse."""
    stages, inputs = [], []
    for f in families:
        column = f"_{f.name}_vec"
        if f.kind == "bits":
            df = df.withColumn(f"_{f.name}_terms", F.transform(f.name, lambda b: b.cast("string")))
            model = CountVectorizerModel.from_vocabulary(
                [str(i) for i in range(f.size)], inputCol=f"_{f.name}_terms", outputCol=column
            )
            stages.append(model.setBinary(True))
        else:
            df = df.withColumn(column, array_to_vector(f.name))
        inputs.append(column)
    for stage in [*stages, VectorAssembler(inputCols=inputs, outputCol=out)]:
        df = stage.transform(df)
    return df.drop(*inputs, *[f"_{f.name}_terms" for f in families if f.kind == "bits"])


def _dense(family: Family) -> Column:
    if family.kind == "dense":
        return F.transform(family.name, lambda v: v.cast("double"))
    places = F.sequence(F.lit(0), F.lit(family.size - 1))
    ones = F.map_from_entries(F.transform(family.name, lambda b: F.struct(b, F.lit(1.0))))

    def spread(found: Column) -> Column:
        return F.transform(places, lambda i: F.coalesce(F.try_element_at(found, i), F.lit(0.0)))

    return T.let(ones, spread)


def dense_array(df: DataFrame, families: Sequence[Family], out: str = "values") -> DataFrame:
    """One array<double> over `families`, for row-local arithmetic."""
    return df.withColumn(out, F.concat(*[_dense(f) for f in families]))


def custom_featurizer(
    df: DataFrame, make: Callable[[], Callable[[str], Sequence[float] | None]], text: str = "text",
    row_id: str = "row_id", out: str = "values",
) -> DataFrame:
    """Any text-to-vector function; `make` runs once per partition, None marks an invalid row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fn = make()
        for batch in batches:
            yield pd.DataFrame({row_id: batch[row_id], out: [fn(t) if t is not None else None for t in batch[text]]})

    kind = dict(df.dtypes)[row_id]
    return df.select(row_id, text).mapInPandas(run, f"{row_id} {kind}, {out} array<double>")
