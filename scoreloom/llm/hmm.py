"""A hidden Markov language model: Baum-Welch counts summed over partitions, exact likelihood by the scaled forward recursion.

Frequent words are symbols of their own. A rarer word is the symbol of its class (by length and final punctuation),
times its smoothed share of the class, so that every word has a probability. Frequent words are few by their share of
all tokens, so their tables may be broadcast; counts of all others are joined by shuffle.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import documents, stored

FOLDS, HELD_OUT = 7, 2
#: A word with this share of all tokens is a symbol (so at most 4,000 are), or is looked up by broadcast (500,000).
SYMBOL_SHARE, KNOWN_SHARE = 1 / 4_000, 1 / 500_000
STATES, ROUNDS, SEED = 8, 4, 7
#: How much likelier than another a state's first guess is to stay as it is.
STICKY = 100.0
#: In training, texts are cut into segments of so many tokens; none is left out. Scoring takes whole texts.
SEGMENT, SEGMENTS_AT_ONCE = 128, 2_000
#: Distinct words that a task counts before it hands them on.
COUNTED_WORDS = 500_000
#: Expected counts are summed as integers in this unit, so that the sum doesn't depend on the order.
UNIT = 1 << 20
SMOOTHING = 1e-3
END, CLASSES, FIRST_WORD = 0, 6, 7  # symbols: the end, six classes of words from 1, then frequent words
WORD_HASH_SEED = 42  # that of the SQL function xxhash64


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()  # on bytes: A-Z, and ASCII white space


def class_of(word: bytes) -> int:
    """1 to 6: up to 4, up to 8 or more bytes, without or with final punctuation."""
    return 1 + (0 if len(word) <= 4 else 1 if len(word) <= 8 else 2) + 3 * (word[-1] in b".,;:!?")


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


COUNTS = pa.schema([("word", pa.string()), ("kind", pa.int32()), ("n", pa.int64())])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        words = list(counts)
        kinds = [class_of(w) if w else END for w in words]
        out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(kinds, pa.int32()), pa.array(counts.values(), pa.int64())], schema=COUNTS)
        counts.clear()
        return out

    for batch in batches:
        for text in batch["text"]:
            counts.update(words_of(text.as_py()))
            counts[b""] += 1  # the end
            if len(counts) > COUNTED_WORDS:
                yield flush()
    if counts:
        yield flush()


class Vocabulary(NamedTuple):
    tokens: int
    words: int
    places: dict[bytes, int]  # of known words, in the arrays below
    symbols: np.ndarray
    logs: np.ndarray  # log10(count + 1)
    n_symbols: int
    class_logs: np.ndarray  # for each symbol, what a word of it costs within its class


def counts(rows: DataFrame) -> DataFrame:
    """(word, kind, n): how often each word stands in (text); the word "" is the end."""
    parts = rows.select("text").mapInArrow(_counted, "word string, kind int, n long")
    return stored(parts.groupBy("word").agg(F.first("kind").alias("kind"), F.sum("n").alias("n")), "words")


def vocabulary(counted: DataFrame) -> tuple[Vocabulary, int]:
    """The frequent words of `counted`, and the least count of those that are looked up by broadcast."""
    n, v = counted.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    least = max(1, math.ceil(n * KNOWN_SHARE))
    known = counted.filter((F.col("n") >= least) & (F.col("word") != "")).select("word", "kind", "n").collect()
    known.sort(key=lambda r: (-r["n"], r["word"]))
    many = max(1, n * SYMBOL_SHARE)
    frequent = sum(r["n"] >= many for r in known)
    ends = n and counted.filter("word = ''").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    symbols = [FIRST_WORD + i if i < frequent else r["kind"] for i, r in enumerate(known)]
    logs = [math.log10(r["n"] + 1) for r in known]
    # The last place is the end's.
    symbols, logs = np.array([*symbols, END], np.uint16), np.array([*logs, math.log10(ends + 1)])
    rest = counted.filter((F.col("n") < many) & (F.col("word") != "")).groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("v"))
    class_logs = np.zeros(FIRST_WORD + frequent)
    for r in rest.collect():
        class_logs[r["kind"]] = -math.log10(r["n"] + r["v"] + 1)
    places = {r["word"].encode(): i for i, r in enumerate(known)}
    return Vocabulary(n, v, places, symbols, logs, FIRST_WORD + frequent, class_logs), least


ENCODED_SQL = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, known_log double, class_log double, rare array<long>, symbols binary"


def encoded(rows: DataFrame, vocab: Vocabulary) -> DataFrame:
    """For each row its symbols (16 bits each), what known words add to the scores, and hashes of the other words."""
    shared = rows.sparkSession.sparkContext.broadcast(vocab)
    types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.binary()]
    schema = pa.schema(list(zip([c.split()[0] for c in ENCODED_SQL.split(", ")], types, strict=True)))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        v = shared.value
        find, row, end, digest = v.places.get, TaskContext.get().partitionId() << 33, len(v.symbols) - 1, xxhash.xxh64_intdigest
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some, out = batch.slice(at, 512), []
                for doc_id, held, text in zip(*(some[c].to_pylist() for c in ("doc_id", "held_out", "text")), strict=True):
                    words = words_of(text)
                    place = np.fromiter(map(find, words, repeat(-1)), np.int64, len(words))
                    place = np.append(place, end)
                    other = np.flatnonzero(place < 0)
                    symbols, logs = v.symbols[place], v.logs[place]
                    rare = [words[i] for i in other.tolist()]
                    symbols[other] = [class_of(w) for w in rare]
                    logs[other] = 0.0
                    hashes = np.array([digest(w, WORD_HASH_SEED) for w in rare], np.uint64).astype(np.int64)
                    classed = (symbols > END) & (symbols < FIRST_WORD)
                    extra = logs[classed].sum() + v.class_logs[symbols].sum()
                    n_known = len(place) - len(other) - (v.logs[end] == 0)
                    out.append((row, doc_id, held, len(place), int(n_known), logs.sum(), extra, hashes, symbols.tobytes()))
                    row += 1
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return stored(rows.mapInArrow(encode, ENCODED_SQL), "symbols")


class Model(NamedTuple):
    first: np.ndarray  # of a text's first state
    later: np.ndarray  # of the first state of a segment within a text
    steps: np.ndarray  # (state, next state)
    emits: np.ndarray  # (symbol, state)


def started(n_symbols: int, states: int = STATES, seed: int = SEED) -> Model:
    """Random emissions, and states that mostly stay, as topics and languages do."""
    rng = np.random.default_rng(seed)
    steps, emits = np.eye(states) * STICKY + rng.uniform(0.5, 1.5, (states, states)), rng.uniform(0.1, 1.9, (n_symbols, states))
    even = np.full(states, 1 / states)
    return Model(even, even, steps / steps.sum(1, keepdims=True), emits / emits.sum(0))


def _segments(symbols: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(flat symbols, begin, length, is first) of segments, the longer ones first, some at a time."""
    flat = np.frombuffer(b"".join(symbols), np.uint16)
    ends = np.cumsum([len(s) // 2 for s in symbols])
    begins = np.concatenate([[0], ends[:-1]])
    n = -(-(ends - begins) // SEGMENT)
    doc = np.repeat(np.arange(len(symbols)), n)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    begin = begins[doc] + k * SEGMENT
    length = np.minimum(ends[doc] - begin, SEGMENT)
    order = np.argsort(-length, kind="stable")
    for at in range(0, len(order), SEGMENTS_AT_ONCE):
        some = order[at : at + SEGMENTS_AT_ONCE]
        yield flat, begin[some], length[some], k[some] == 0


def expected(model: Model, flat: np.ndarray, begin: np.ndarray, length: np.ndarray, is_first: np.ndarray) -> Model:
    """Expected counts of first and later starts, steps and emissions, for segments with the longer ones first."""
    states, longest = len(model.first), int(length[0])
    active = np.searchsorted(-length, -np.arange(longest), side="left")  # segments longer than t
    alphas, likes, scales, counted = [], [], [], []
    for t in range(longest):
        m = active[t]
        symbols = flat[begin[:m] + t]
        like = model.emits[symbols]
        prior = np.where(is_first[:m, None], model.first, model.later) if t == 0 else alphas[-1][:m] @ model.steps
        alpha = prior * like
        scale = alpha.sum(1, keepdims=True)
        alpha /= scale
        alphas.append(alpha), likes.append(like), scales.append(scale), counted.append(symbols)
    steps, beta = np.zeros((states, states)), np.ones((active[-1], states))
    gammas = [None] * longest
    for t in range(longest - 1, -1, -1):
        if t < longest - 1:
            m = active[t + 1]
            ahead = likes[t + 1] * beta / scales[t + 1]
            steps += alphas[t][:m].T @ ahead
            beta = np.ones((active[t], states))
            beta[:m] = ahead @ model.steps.T
        gammas[t] = alphas[t] * beta
    symbols, gamma = np.concatenate(counted), np.concatenate(gammas)
    emits = np.stack([np.bincount(symbols, gamma[:, s], len(model.emits)) for s in range(states)], 1)
    head = gammas[0]
    return Model(head[is_first].sum(0), head[~is_first].sum(0), steps * model.steps, emits)


def trained(coded: DataFrame, n_symbols: int, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all rows that are not held out; a round gathers one number for each cell of the tables."""
    model = started(n_symbols, states)
    shapes = [a.shape for a in model]
    sizes = [a.size for a in model]
    for _ in range(rounds):
        shared = coded.sparkSession.sparkContext.broadcast(model)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value  # noqa: B023
            total = np.zeros(sum(sizes))
            for batch in batches:
                for at in range(0, batch.num_rows, 2048):
                    for part in _segments(batch["symbols"].slice(at, 2048).to_pylist()):
                        total += np.concatenate([a.ravel() for a in expected(m, *part)])
            whole = np.rint(total * UNIT).astype(np.int64)
            cells = np.flatnonzero(whole)
            yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(whole[cells])], names=["cell", "n"])

        sums = coded.filter("not held_out").select("symbols").mapInArrow(count, "cell int, n long")
        cells = sums.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        total = np.zeros(sum(sizes))
        total[cells["cell"].to_numpy(np.int64)] = cells["n"].to_numpy(np.float64) / UNIT
        first, later, steps, emits = (a.reshape(s) + SMOOTHING for a, s in zip(np.split(total, np.cumsum(sizes)[:-1]), shapes, strict=True))
        model = Model(first / first.sum(), later / later.sum(), steps / steps.sum(1, keepdims=True), emits / emits.sum(0))
        shared.unpersist()
    return model


def likelihoods(model: Model, symbols: list[bytes]) -> np.ndarray:
    """log10 probability of each whole sequence of symbols, the longer ones side by side with all others."""
    flat = np.frombuffer(b"".join(symbols), np.uint16)
    length = np.array([len(s) // 2 for s in symbols])
    order = np.argsort(-length, kind="stable")
    begin, sorted_ = (np.cumsum(length) - length)[order], length[order]
    active = np.searchsorted(-sorted_, -np.arange(sorted_[0] if len(sorted_) else 0), side="left")
    out, alpha = np.zeros(len(symbols)), None
    for t, m in enumerate(active):
        prior = model.first if alpha is None else alpha[:m] @ model.steps
        alpha = prior * model.emits[flat[begin[:m] + t]]
        scale = alpha.sum(1, keepdims=True)
        alpha /= scale
        out[order[:m]] += np.log10(scale[:, 0])
    return out


def scored(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of (doc_id, text).

    A null or empty text has one token, its end. A null doc_id counts as the empty text for the fold. Repeated rows
    count and are scored each for itself. An empty table gives no rows; if all rows are held out, no word is known.
    Other columns are left out. Words are joined by a 64-bit hash.
    """
    rows = documents(docs).withColumn("held_out", held_out(F.col("doc_id")))
    counted = counts(rows.filter("not held_out"))
    vocab, least = vocabulary(counted)
    coded = encoded(rows, vocab)
    model = trained(coded, vocab.n_symbols, states, rounds)
    rest = counted.filter((F.col("n") < least) & (F.col("word") != "")).select(F.xxhash64("word").alias("hash"), "n")
    rare = coded.select("row", F.explode("rare").alias("hash")).join(rest, "hash")
    added = rare.groupBy("row").agg(F.sum(F.log10(F.col("n") + 1)).alias("rare_log"), F.count("*").alias("rare_known"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array(likelihoods(shared.value, batch["symbols"].to_pylist()))
            names = [c for c in batch.schema.names if c != "symbols"]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), values], names=[*names, "hmm"])

    narrow = coded.drop("rare").select("row", "doc_id", "held_out", "n_tokens", "n_known", "known_log", "class_log", "symbols")
    made = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, known_log double, class_log double, hmm double"
    df = narrow.mapInArrow(score, made).join(added, "row", "left").fillna(0, ["rare_log", "rare_known"])
    cost = math.log10(vocab.tokens + vocab.words + 1)
    return df.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("known_log") + F.col("rare_log") - F.col("n_tokens") * F.lit(cost)).alias("base_score"),
        (F.col("hmm") + F.col("class_log") + F.col("rare_log")).alias("score"),
    )
