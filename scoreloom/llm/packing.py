"""Packing into sequences of bounded length: a fixed number of open windows a partition, best fit, then leftovers."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import documents, stored
from scoreloom.llm.tokens import encoder

CAPACITY, WINDOWS = 4096, 32
#: A document is not cut to fill a gap below this; such gaps are padded.
LEAST_CUT = 16
#: Ids of leftovers that one task merges.
MERGED_IDS = 16_000_000
BATCH_DOCS = 256

Piece = tuple[int | None, int, bytes, int]  # doc_id, start in the document, ids (4 bytes each), ids of the document
ROW_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.binary())]
)
ROW = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class Packer:
    """Places pieces in at most `windows` open windows; `done` has the finished ones until they are taken."""

    def __init__(self, capacity: int = CAPACITY, windows: int = WINDOWS, least: int = LEAST_CUT):
        self.capacity, self.windows, self.least = capacity, windows, least
        self.open: list[list] = []  # each [length, pieces]
        self.done: list[list[Piece]] = []

    def add(self, piece: Piece) -> None:
        while True:
            n = len(piece[2]) // 4
            if n >= self.capacity:
                first, piece = self._cut(piece, self.capacity)
                self.done.append([first])
                if n == self.capacity:
                    return
                continue
            best = max((w for w in self.open if w[0] + n <= self.capacity), key=lambda w: w[0], default=None)
            if best is None and len(self.open) < self.windows:
                self.open.append([n, [piece]])
                return
            if best is not None:
                best[0] += n
                best[1].append(piece)
                if best[0] == self.capacity:
                    self._finish(best)
                return
            fullest = max(self.open, key=lambda w: w[0])
            gap = self.capacity - fullest[0]
            if gap >= self.least:
                first, piece = self._cut(piece, gap)
                fullest[1].append(first)
            self._finish(fullest)

    @staticmethod
    def _cut(piece: Piece, n: int) -> tuple[Piece, Piece]:
        doc_id, start, ids, total = piece
        return (doc_id, start, ids[: 4 * n], total), (doc_id, start + n, ids[4 * n :], total)

    def _finish(self, window: list) -> None:
        self.open.remove(window)
        self.done.append(window[1])

    def merge(self) -> None:
        """Close all open windows, the fuller ones first, filling each with the pieces of the emptiest."""
        pieces = [p for w in sorted(self.open, key=lambda w: -w[0]) for p in w[1]]
        self.open, room, now = [], self.capacity, []
        for piece in pieces:
            while len(piece[2]) // 4 > room:
                first, piece = self._cut(piece, room)
                self.done.append([*now, first])
                room, now = self.capacity, []
            now.append(piece)
            room -= len(piece[2]) // 4
            if not room:
                self.done.append(now)
                room, now = self.capacity, []
        if now:
            self.done.append(now)


class _Rows:
    """Rows of finished sequences, numbered within the task."""

    def __init__(self, first: int):
        self.next, self.rows = first, []

    def take(self, packer: Packer) -> None:
        for pieces in packer.done:
            offset = 0
            for doc_id, start, ids, total in pieces:
                n = len(ids) // 4
                self.rows.append((doc_id, start, n, zlib.crc32(ids), total, self.next, offset, None))
                offset += n
            self.next += 1
        packer.done = []

    def batch(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        return _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ROW_ARROW, strict=True)], schema=ROW_ARROW)


def packed(
    docs: DataFrame, tokenizer: str, end: int, capacity: int = CAPACITY, windows: int = WINDOWS, least: int = LEAST_CUT
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset): every id of every row in exactly one piece.

    A null or empty text has only the id `end`. Repeated rows are packed each for itself; null ids stay null. An
    empty table gives no rows. Other columns are left out. Open windows at the end of a partition go on as leftovers,
    with their ids, and are merged by tasks of up to MERGED_IDS ids, which leave at most one sequence unfilled each.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer), Packer(capacity, windows, least)
        rows = _Rows(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_DOCS):
                some = batch.slice(i, BATCH_DOCS)
                texts = encode.texts(some["text"].to_pylist(), end)
                for doc_id, ids in zip(some["doc_id"].to_pylist(), texts, strict=True):
                    packer.add((doc_id, 0, ids, len(ids) // 4))
                rows.take(packer)
            if rows.rows:
                yield rows.batch()
        left = [(d, s, len(ids) // 4, None, total, None, None, ids) for _, pieces in packer.open for d, s, ids, total in pieces]
        if left:
            yield _batch(left)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, rows = Packer(capacity, windows, least), _Rows(1 << 62 | TaskContext.get().partitionId() << 32)
        for batch in batches:
            for piece in zip(*(batch[c].to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")), strict=True):
                packer.add(piece)
            rows.take(packer)
        packer.merge()
        rows.take(packer)
        if rows.rows:
            yield rows.batch()

    first = stored(documents(docs).mapInArrow(pack, ROW), "packed")
    left = first.filter("sequence_id is null")
    ids = left.agg(F.sum("length")).first()[0] or 0
    dealt = left.repartition(1 + ids // MERGED_IDS, "doc_id", "start").sortWithinPartitions("doc_id", "start")
    out = first.filter("sequence_id is not null").unionByName(dealt.mapInArrow(merge, ROW))
    return out.drop("ids")
