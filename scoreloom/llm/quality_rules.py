"""Quality rules: text statistics, and the divergence of a document from its language's reference.

Everything is DataFrame functions. A document is judged from its own row; only the references are aggregated, and they
are small: one row for each language.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import WORD, broadcast_up_to, documents, name, stored

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
WINDOW = 8
MIN_WORDS, MAX_REPEAT = 20, 30

#: Classes of characters, in this order; wide is the bytes of UTF-8 beyond one a character, rest all others.
CLASSES = ("symbol", "digit", "upper", "wide", "rest")
#: A common word has at most so many characters and makes up this share of its language's words of such length, so a
#: language has at most 100 of them.
COMMON_CHARS, COMMON_SHARE = 6, 0.01
#: Shorter documents, and languages with fewer words in all, are not judged by their divergence.
MIN_JUDGED_WORDS, MIN_JUDGED_CHARS, MIN_REFERENCE_WORDS = 50, 200, 1_000
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.31, 0.42
#: Common words are missing in a text with less than this share of those expected, and less by so many roots of that
#: number; or if those it lacks altogether would be so many: chances under one in a thousand if words were independent.
MIN_COMMON_SHARE, COMMON_DEVIATIONS, MAX_MISSING = 1 / 3, 2.5, 12
MAX_BROADCAST_LANGUAGES = 1_000


def _words() -> Column:
    return F.array_remove(F.split("text", SPACE), "")


def _removed(pattern: str) -> Column:
    return (F.length("text") - F.length(F.regexp_replace("text", pattern, ""))).cast("long")


def examined(rows: DataFrame) -> DataFrame:
    """rows (text, ...) with n_dup_lines, n_repeat_words and base_failed."""
    words = rows.withColumn("words", _words())
    n_words = F.size("words")
    failed = (n_words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * n_words)
    return with_repeats(words).withColumn("base_failed", failed).drop("words")


def common_words(docs: DataFrame) -> DataFrame:
    """(word_lang, common): for each language of (text, lang) its common words, the most frequent first.

    A run without letter or digit is no word here.
    """
    words = docs.select("lang", F.explode(_words()).alias("word")).filter(F.length("word") <= COMMON_CHARS)
    words = words.filter(F.col("word").rlike(r"[\p{L}\p{N}]"))
    counted = stored(words.groupBy("lang", "word").agg(F.count("*").alias("n")), "word-counts")
    totals = stored(counted.groupBy(F.col("lang").alias("word_lang")).agg(F.sum("n").alias("total")), "word-totals")
    joined = counted.join(broadcast_up_to(totals, MAX_BROADCAST_LANGUAGES), F.col("lang").eqNullSafe(F.col("word_lang")))
    common = joined.filter(F.col("n") >= COMMON_SHARE * F.col("total"))
    order = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "word")))
    return common.groupBy("word_lang").agg(order.getField("word").alias("common"))


def measured(docs: DataFrame, common: DataFrame) -> DataFrame:
    """docs (text, lang, ...) with n_words, word_chars, n_chars, classes, hits (of each common word) and windows_."""
    df = docs.withColumn("words", _words())
    df = df.join(broadcast_up_to(common, MAX_BROADCAST_LANGUAGES), F.col("lang").eqNullSafe(F.col("word_lang")), "left")
    df = df.withColumns({"symbol_": _removed(SYMBOLS), "digit_": _removed("[0-9]+"), "upper_": _removed("[A-Z]+")})
    df = df.withColumn("wide_", (F.octet_length("text") - F.length("text")).cast("long"))
    rest = F.length("text") - F.col("symbol_") - F.col("digit_") - F.col("upper_")
    return df.select(
        *docs.columns, "words", F.size("words").cast("long").alias("n_words"), F.length("text").cast("long").alias("n_chars"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"), F.col("symbol_").alias("n_symbols"),
        F.array("symbol_", "digit_", "upper_", "wide_", rest).alias("classes"),
        F.transform("common", lambda w: (F.size("words") - F.size(F.array_remove("words", w))).cast("long")).alias("hits"),
    )


def _dup_lines() -> Column:
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(WORD))
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def with_repeats(df: DataFrame) -> DataFrame:
    """Adds n_dup_lines and n_repeat_words to (text, words, ...).

    Hashes of 2, then 4, then 8 words are chained. A window of 8 found twice has five windows of 4 found twice, so
    only texts with so many go on to windows of 8, and only those with repeats sort them with their places.
    """

    def pairs(column: str, step: int) -> Column:
        return F.transform(column, lambda x, i: F.xxhash64(x, F.get(F.col(column), i + step)))

    last = F.greatest(F.size("words") - WINDOW + 1, F.lit(0))
    out = df.withColumn("two_", pairs("words", 1))
    out = out.withColumn("four_", pairs("two_", 2))
    suspect = (F.size("four_") - F.size(F.array_distinct("four_")) >= 5) & (last > 1)
    out = out.withColumn("eight_", F.when(suspect, F.slice(pairs("four_", 4), F.lit(1), last)))
    twice = F.size("eight_") > F.size(F.array_distinct("eight_"))
    sorted_ = F.sort_array(F.transform("eight_", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("sorted_", F.when(twice, sorted_))

    def there(i: Column) -> Column:
        return F.get(F.col("sorted_"), i)["h"]

    equal = F.filter("sorted_", lambda x, i: x["h"].eqNullSafe(there(i - 1)) | x["h"].eqNullSafe(there(i + 1)))
    out = out.withColumn("places_", F.sort_array(equal.getField("i")))
    ends = F.transform("places_", lambda p, i: F.least(F.get(F.col("places_"), i + 1) - p, F.lit(WINDOW)))
    covered = F.coalesce(F.aggregate(ends, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    return out.select(*df.columns, _dup_lines().alias("n_dup_lines"), covered.alias("n_repeat_words"))


def references(measures: DataFrame) -> DataFrame:
    """(ref_lang, class_share, word_share, ref_words) for each language, from (lang, classes, hits, n_words) of rows.

    word_share follows the language's common words and ends with the share of all other words.
    """
    sums = measures.groupBy(F.col("lang").alias("ref_lang")).agg(
        *[F.sum(F.get("classes", F.lit(i))).alias(k) for i, k in enumerate(CLASSES)], F.sum("n_words").alias("ref_words")
    )
    hits = measures.select("lang", F.posexplode("hits").alias("i", "n")).groupBy("lang", "i").agg(F.sum("n").alias("n"))
    hits = hits.groupBy(F.col("lang").alias("hit_lang")).agg(F.sort_array(F.collect_list(F.struct("i", "n"))).getField("n").alias("ref_hits"))
    df = sums.join(hits, F.col("ref_lang").eqNullSafe(F.col("hit_lang")), "left")
    df = df.withColumns({"class_sums": F.array(*CLASSES), "word_sums": _with_rest("ref_hits", "ref_words")})
    return df.select(
        "ref_lang", "ref_words", _shares("class_sums").alias("class_share"), _shares("word_sums").alias("word_share")
    )


def _total(column: str) -> Column:
    return F.aggregate(column, F.lit(0).cast("long"), lambda a, x: a + x)


def _with_rest(hits: str, words: str) -> Column:
    return F.concat(F.col(hits), F.array(F.col(words) - _total(hits)))


def _shares(column: str) -> Column:
    return F.transform(column, lambda x: F.try_divide(x, _total(column)))


def distance(counts: Column, share: Column) -> Column:
    """Jensen-Shannon distance (base 2, from 0 to 1) of two distributions, arrays of equal length."""

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    terms = F.zip_with(counts, share, lambda p, q: part(p, (p + q) / 2) + part(q, (p + q) / 2))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x), F.lit(0.0)) / 2)


def lacks_common_words() -> Column:
    """Whether a row with (hits, n_words) and its language's word_share has too few of the common words, or not some."""
    shares = F.slice("word_share", F.lit(1), F.size("word_share") - 1)
    expected = F.col("n_words") * F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    least = F.least(MIN_COMMON_SHARE * expected, expected - COMMON_DEVIATIONS * F.sqrt(expected))
    absent = F.zip_with("hits", shares, lambda n, share: F.when(n == 0, share).otherwise(0.0))
    missing = F.col("n_words") * F.aggregate(absent, F.lit(0.0), lambda a, x: a + x)
    return (_total("hits") < least) | (missing > MAX_MISSING)


def verdicts(measures: DataFrame, refs: DataFrame) -> DataFrame:
    """Adds class_distance, word_distance and kept; needs all measures and references."""
    df = measures.join(broadcast_up_to(refs, MAX_BROADCAST_LANGUAGES), F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    df = df.withColumns({"word_counts_": _with_rest("hits", "n_words")})
    enough = (
        (F.col("n_chars") >= MIN_JUDGED_CHARS) & (F.col("n_words") >= MIN_JUDGED_WORDS)
        & (F.col("ref_words") >= MIN_REFERENCE_WORDS)
    )
    df = df.withColumns(
        {
            "class_distance": F.when(enough, F.round(distance(_shares("classes"), F.col("class_share")), 6)),
            "word_distance": F.when(enough, F.round(distance(_shares("word_counts_"), F.col("word_share")), 6)),
        }
    )
    far = (F.col("class_distance") > MAX_CLASS_DISTANCE) | (F.col("word_distance") > MAX_WORD_DISTANCE)
    far |= enough & lacks_common_words()
    return df.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))


def _rows(docs: DataFrame, *more: Column) -> DataFrame:
    return documents(docs, F.col("lang").cast("string").alias("lang"), *more)


def judged(docs: DataFrame) -> DataFrame:
    """Every row of docs (doc_id, text, lang) with its statistics, class_distance, word_distance and kept.

    Texts far from their language's reference, or without its common words, are not kept. Common words and references
    come from the rows that the base rules keep, so junk doesn't decide what is good. Null and empty texts have no
    words: base_failed is true, the distances are null. Short texts and those of a language with few words in kept rows
    have null distances and are kept if the base rules keep them. Very long texts are judged whole. A null language is
    one like any other. Repeated rows are judged alike. An empty table gives no rows. Other columns are left out, so
    clashing names don't matter.
    """
    rows = stored(examined(_rows(docs)), "examined")  # later passes read it
    measures = measured(rows, stored(common_words(rows.filter("not base_failed")), "common-words"))
    measures = stored(measures.drop("text", "words"), "measures")
    df = verdicts(measures, stored(references(measures.filter("not base_failed")), "references"))
    return df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "class_distance",
        "word_distance", "kept",
    )


def filtered(docs: DataFrame) -> DataFrame:
    """The rows of docs that `judged` keeps, with all their columns and nothing else; no row's text is shuffled.

    Null, empty and very long texts and repeated rows are judged as there; an empty table gives no rows.
    """
    rows = examined(_rows(docs, F.struct(*[name(c) for c in docs.columns]).alias("row_")))
    # Written before rows are filtered: a filter would be pushed below all that it is made of, and work it out again.
    rows = stored(rows.drop("text"), "examined").filter("not base_failed")
    rows = rows.withColumn("text", F.coalesce("row_.text", F.lit("")))
    measures = measured(rows, stored(common_words(rows), "common-words"))
    refs = stored(references(stored(measures.select("lang", "classes", "hits", "n_words"), "measures")), "references")
    # A filter would be pushed below the columns it uses, and work them out again; a generator stays where it is.
    kept = verdicts(measures, refs).select(F.explode(F.when(F.col("kept"), F.array("row_"))).alias("row_"))
    return kept.select(*[F.col("row_").getField(c).alias(c) for c in docs.columns])
