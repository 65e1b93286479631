"""Homomorphic multiset hash of a text's paragraphs: sums, modulo powers of two, of wide vectors hashed from each.

The sum doesn't depend on the paragraphs' order, and paragraphs can be added to or taken from it without the rest.
It has three parts: exact lanes (uniform, 32 bits wide) for equality; sketch lanes (24 bits wide), to which a paragraph
adds a number from a Cauchy distribution; and the number of paragraphs (32 bits). Cauchy numbers add up to such a number
as wide as their weights together, so the width of a difference's lanes tells how many paragraphs are unlike, each copy
of a repeated one counted: of 96 lanes with a standard error of a seventh of that number.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm.common import documents, stored

EXACT_LANES, SKETCH_LANES = 8, 96
#: Bits of a sketch lane, and the unit of its numbers. Lanes overflow only where more than about 20,000 are unlike.
SKETCH_BITS, UNIT = 24, 16
ROUNDS = 5


@functools.cache
def quantiles() -> np.ndarray:
    """The Cauchy distribution at 65,536 even steps, in units."""
    steps = (np.arange(1 << 16) + 0.5) / (1 << 16)
    return np.round(UNIT * np.tan(np.pi * (steps - 0.5))).astype(np.int64).astype(np.uint32)


def paragraphs(text: str) -> list[str]:
    """Lines, cut further after each sentence; an empty text is one empty paragraph."""
    return text.replace(". ", ".\n").split("\n")


class Fingerprint(NamedTuple):
    exact: np.ndarray
    sketch: np.ndarray
    count: int

    def __add__(self, other: Fingerprint) -> Fingerprint:  # type: ignore[override]
        return Fingerprint(self.exact + other.exact, self.sketch + other.sketch, self.count + other.count & 0xFFFFFFFF)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.sketch - other.sketch, self.count - other.count & 0xFFFFFFFF)

    def hex(self) -> str:
        sketch = self.sketch.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : SKETCH_BITS // 8]
        return (self.exact.astype("<u4").tobytes() + sketch.tobytes() + self.count.to_bytes(4, "little")).hex()


def parse(text: str) -> Fingerprint:
    raw, at = bytes.fromhex(text), 4 * EXACT_LANES
    end = at + SKETCH_BITS // 8 * SKETCH_LANES
    sketch = np.zeros((SKETCH_LANES, 4), np.uint8)
    sketch[:, : SKETCH_BITS // 8] = np.frombuffer(raw[at:end], np.uint8).reshape(SKETCH_LANES, -1)
    return Fingerprint(np.frombuffer(raw[:at], "<u4"), sketch.view("<u4").ravel(), int.from_bytes(raw[end:], "little"))


def digest(paragraph: str) -> bytes:
    """The hashes that make up a paragraph's vector."""
    return hashlib.shake_128(paragraph.encode("utf-8", "surrogatepass")).digest(4 * EXACT_LANES + 2 * SKETCH_LANES)


def total(digests: Sequence[bytes]) -> Fingerprint:
    """Sum of the vectors of some paragraphs."""
    exact, sketch = np.zeros(EXACT_LANES, np.uint32), np.zeros(SKETCH_LANES, np.uint32)
    for at in range(0, len(digests), 4096):  # bounded memory for very long texts
        some = digests[at : at + 4096]
        rows = np.frombuffer(b"".join(some), np.uint8).reshape(len(some), -1)
        exact += np.ascontiguousarray(rows[:, : 4 * EXACT_LANES]).view("<u4").sum(0, dtype=np.uint32)
        sketch += quantiles()[np.ascontiguousarray(rows[:, 4 * EXACT_LANES :]).view("<u2")].sum(0, dtype=np.uint32)
    return Fingerprint(exact, sketch, len(digests) & 0xFFFFFFFF)


def of(parts: Sequence[str]) -> Fingerprint:
    """Fingerprint of a multiset of paragraphs."""
    return total([digest(p) for p in parts])


def unlike(a: Fingerprint, b: Fingerprint) -> float:
    """About how many paragraphs are in one but not in the other: the likeliest width of the lanes' difference."""
    shift = 32 - SKETCH_BITS
    lanes = np.abs(((a.sketch - b.sketch) << np.uint32(shift)).view(np.int32) >> shift).astype(np.float64) / UNIT
    squares, width = lanes * lanes, float(np.partition(lanes, len(lanes) // 2)[len(lanes) // 2])
    for _ in range(ROUNDS if width else 0):
        width = float(np.sqrt(np.mean(2 * squares / (1 + squares / (width * width)))))
    return width


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """About the paragraphs in both, twice, to those of each: 1 for equal fingerprints, 0 for nothing in common."""
    if a.count == b.count and (a.exact == b.exact).all():
        return 1.0
    return min(1.0, max(0.0, 1 - unlike(a, b) / (a.count + b.count)))


class _Document(NamedTuple):
    doc_id: int | None
    text: str
    digests: dict[str, bytes]
    fingerprint: Fingerprint


def _document(doc_id: int | None, text: str) -> _Document:
    parts = paragraphs(text)
    digests = {p: digest(p) for p in set(parts)}
    return _Document(doc_id, text, digests, total([digests[p] for p in parts]))


def _row(now: _Document, following: _Document) -> tuple:
    """The document compared with its edited text; only a paragraph that neither text has is hashed anew."""
    half = len(now.text) // 2
    new = now.text[: len(now.text) - half] + following.text[:half]
    known = following.digests | now.digests
    changed = total([known.get(p) or digest(p) for p in paragraphs(new)])
    own = now.fingerprint
    return (
        now.doc_id, len(now.text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), own.hex(), changed.hex(),
        likeness(own, changed), likeness(own, following.fingerprint),
    )


DONE = [("doc_id", pa.int64()), ("n_chars", pa.int64()), *[(c, pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]] + [
    (c, pa.float64()) for c in ("near_edited", "near_next")
]
DONE_SQL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
#: Rows of the ends of partitions have the partition and the text of its first or last document instead.
PART = pa.schema([*DONE, ("part", pa.int32()), ("is_first", pa.bool_()), ("text", pa.string())])
PART_SQL = DONE_SQL + ", part int, is_first boolean, text string"


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compares each row with the next one of its partition."""
    part, last = TaskContext.get().partitionId(), None

    def end(doc: _Document, first: bool) -> tuple:
        return doc.doc_id, *[None] * 6, part, first, doc.text

    for batch in batches:
        for i in range(0, batch.num_rows, 256):
            some, rows = batch.slice(i, 256), []
            for doc_id, text in zip(some["doc_id"].to_pylist(), some["text"].to_pylist(), strict=True):
                now = _document(doc_id, text)
                rows.append(end(now, True) if last is None else (*_row(last, now), part, None, None))
                last = now
            yield _batch(rows, PART)
    if last is not None:
        yield _batch([end(last, False)], PART)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch[c].to_pylist() for c in ("doc_id", "text", "next_text"))
        rows = [_row(_document(d, text), _document(None, following)) for d, text, following in zip(*columns, strict=True)]
        if rows:
            yield _batch(rows, pa.schema(DONE))


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; the next text is the next lower doc_id's.

    Edited: the last floor(n_chars / 2) code points are replaced by as many first ones of the next text. Order is by
    falling doc_id, nulls last, then by a hash of the text, so that repeated rows follow each other; the row after the
    last is the first, and a single row follows itself. A null text is empty. An empty table gives no rows; other
    columns are left out. Texts are shuffled once, into ranges; a task reads its range as a stream. The ends of ranges,
    one text each, are compared in a second step.
    """
    rows = documents(docs).withColumns({"hash_": F.xxhash64("text"), "place_": F.monotonically_increasing_id()})
    order = [F.col("doc_id").desc_nulls_last(), F.col("hash_"), F.col("place_")]
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    parts = stored(ranges.mapInArrow(_within, PART_SQL), "fingerprints")
    names = [c for c, _ in DONE]
    firsts, lasts = parts.filter("is_first"), parts.filter("not is_first")
    # One row for each range: which range follows it.
    following = F.lead("part").over(Window.orderBy("part"))
    links = firsts.select("part").withColumn("next_part", F.coalesce(following, F.min("part").over(Window.partitionBy())))
    heads = firsts.select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    ends = lasts.join(links, "part").join(heads, "next_part").select("doc_id", "text", "next_text")
    return parts.filter("is_first is null").select(*names).unionByName(ends.mapInArrow(_across, DONE_SQL))
