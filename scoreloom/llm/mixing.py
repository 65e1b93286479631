"""Mixing sources to target weights: hash-random keys, prefix sums of sizes within each source, a cut at its budget.

Everything is DataFrame functions. Only (source, key, size) is shuffled; a row is then compared with its source's cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm.common import WORD, broadcast_up_to, fresh, name, stored

WEIGHTS = (1.0, 2.0, 3.0)
MAX_TIMES = 3
SEED = "mix"
#: Hexadecimal digits of the key that cut a source into ranges, each sorted by one task.
RANGE_DIGITS = 3
MAX_BROADCAST_SOURCES = 10_000


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def key_of(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """A key that any engine can make: the MD5 of seed and id, then that of the text, for rows of one id or none."""
    id_ = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.concat(id_, F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, max_times: int = MAX_TIMES) -> DataFrame:
    """(source, source_size, target) for each source of (source, size).

    Sources in order of code points, null last, weigh `weights`, repeating. They share all sizes; a target stops at
    `max_times` its source's size, and the excess is shared again by weight. In order of size by weight, a source is
    capped if its cap is at most its share of what the capped ones before it leave.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), place % len(weights))
    df = sources.withColumn("weight", weight).withColumn("cap", max_times * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_first())
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    df = df.withColumn("level", left / F.sum("weight").over(after))
    df = df.withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    first = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNotNull(), "source", "level"))).over(whole)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(first["level"] * F.col("weight"))
    return df.select("source", "source_size", target.alias("target"))


def cuts(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """(cut_source, source_size, target, epochs, cut_key, cut_rest, cut_size) for each source.

    The source is taken `epochs` times whole, then up to cut_key: keys before it whole, and cut_rest of the cut_size
    words at it. rows: (source, key, size). A source is cut into ranges of keys, whose sums give each its offset, so a
    task sorts one range of one source; keys are random, so ranges are even.
    """
    ranged = rows.groupBy("source", "key").agg(F.sum("size").alias("size")).withColumn("range", F.substring("key", 1, RANGE_DIGITS))
    sums = ranged.groupBy(F.col("source").alias("s"), F.col("range").alias("r")).agg(F.sum("size").alias("sum"))
    until = Window.partitionBy("s").orderBy("r").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("offset", F.sum("sum").over(until) - F.col("sum"))
    budget = F.floor("target").cast("long")
    goals = goals.withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
    goals = stored(goals.withColumn("rest", budget - F.col("epochs") * F.col("source_size")), "goals")
    small = broadcast_up_to(goals, MAX_BROADCAST_SOURCES)
    # Only the range that holds a source's cut is sorted.
    held = sums.join(small.select(F.col("source").alias("g"), "rest"), F.col("s").eqNullSafe(F.col("g")))
    held = stored(held.filter((F.col("rest") >= F.col("offset")) & (F.col("rest") < F.col("offset") + F.col("sum"))).select("s", "r", "offset", "rest"), "ranges")
    inside = ranged.join(broadcast_up_to(held, MAX_BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    upto = Window.partitionBy("source", "range").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("end", F.col("offset") + F.sum("size").over(upto))
    at = inside.filter((F.col("rest") < F.col("end")) & (F.col("rest") >= F.col("end") - F.col("size")))
    found = at.select("s", F.col("key").alias("cut_key"), (F.col("rest") - F.col("end") + F.col("size")).alias("cut_rest"), F.col("size").alias("cut_size"))
    joined = goals.join(found, F.col("source").eqNullSafe(F.col("s")), "left")
    return joined.select(F.col("source").alias("cut_source"), "source_size", "target", "epochs", "cut_key", "cut_rest", "cut_size")


def taken(place: Column) -> Column:
    """Words taken of a row (key, size) joined with its source's cut; `place`: rows of its key before it."""
    at = F.greatest(F.lit(0), F.least(F.col("size"), F.col("cut_rest") - place * F.col("size")))
    last = F.when(F.col("key") < F.col("cut_key"), F.col("size")).when(F.col("key") == F.col("cut_key"), at).otherwise(0)
    return F.col("epochs") * F.col("size") + F.coalesce(last, F.lit(0))


def _taken(docs: DataFrame, carried: Column) -> DataFrame:
    """(doc_id, source, key, size, carried, taken) with the numbers of the source's cut.

    Rows at a cut are equal in all that decides. They are written once with the part they are in, and numbered by
    parts, so that many of them are not numbered by one task; any of them may be the one taken in part.
    """
    source, doc_id = F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id")
    key, size = key_of(F.col("doc_id"), F.col("text")).alias("key"), size_of(F.col("text")).alias("size")
    rows = stored(docs.select(source, key, size), "sizes")
    found = stored(cuts(rows, targets(rows)), "cuts")
    small = broadcast_up_to(found, MAX_BROADCAST_SOURCES)
    full = docs.select(doc_id, source, key, size, carried.alias("carried"))
    full = full.join(small, F.col("source").eqNullSafe(F.col("cut_source")), "left")
    at_cut = F.coalesce(F.col("key") == F.col("cut_key"), F.lit(False))
    others = full.filter(~at_cut).withColumn("taken", taken(F.lit(0)))
    equal = stored(full.filter(at_cut).withColumn("part", F.spark_partition_id()), "at-cuts")
    parts = equal.groupBy(F.col("cut_source").alias("s"), F.col("part").alias("p")).agg(F.count("*").alias("held"))
    before = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("s", "p", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("cut_source", "part").orderBy("key"))
    placed = equal.withColumn("inside", inside).join(parts, F.col("cut_source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p")))
    placed = placed.withColumn("taken", taken(F.col("before") + F.col("inside") - 1))
    return others.unionByName(placed.select(*others.columns))


def mixed(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) for every row of (doc_id, text, source).

    A null or empty text has size 0 and gives nothing; very long ones count whole. A null source is one like any other.
    Rows of one id, or of none, follow each other by the hash of the text; of equal rows at a cut some are taken, and
    at most one row of a source is taken in part. An empty table gives no rows; other columns are left out.
    """
    return _taken(docs, F.lit(0)).select("doc_id", "source", "size", "source_size", "target", "taken")


def resampled(docs: DataFrame) -> DataFrame:
    """docs as the mix takes them, with all their columns and nothing else: whole copies, and at the cut the first words.

    A document without words is not taken. Rows are as in `mixed`; an empty table gives no rows.
    """
    df = _taken(docs, F.struct(*[name(c) for c in docs.columns]))
    rest = F.when(F.col("size") > 0, F.col("taken") % F.col("size")).otherwise(0).cast("int")
    copies = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    whole = F.array_repeat(F.lit(-1), copies)
    df = df.select("carried", F.explode(F.concat(whole, F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))).alias("words"))
    # Cut where a word ends: every part is a word with the white space before it.
    text = F.col("carried.text")
    parts = F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    cut = F.when(F.col("words") >= 0, F.array_join(F.slice(parts, 1, F.col("words")), "")).otherwise(text)
    return df.select(*[(cut if c == "text" else F.col("carried").getField(c)).alias(c) for c in docs.columns])
