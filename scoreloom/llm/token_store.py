"""Token ids in binary files of independent zstandard frames, with a seek table and checksums.

A file: data frames; a skippable frame with the documents' ids and lengths; a skippable frame with the seek table
(sizes and checksums of all frames), as zstandard's seekable format has it. A data frame holds the ids of some whole
documents, one after another. A reader takes the last bytes, then only the frames of the documents it wants.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloom.llm.common import documents, stored
from scoreloom.llm.tokens import encoder
from scoreloom.session import scratch_path

#: Fixed values of zstandard's format.
SKIPPABLE_INDEX, SKIPPABLE_SEEK, SEEKABLE = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80

FRAME_IDS = 65_536
LEVEL = 3
BATCH_DOCS = 256


class Shard(NamedTuple):
    part: int
    path: str
    docs: int
    ids: int
    frames: int
    bytes: int


SHARD = "part int, path string, docs long, ids long, frames long, bytes long"
SHARD_ARROW = pa.schema(
    [("part", pa.int32()), ("path", pa.string()), *[(c, pa.int64()) for c in ("docs", "ids", "frames", "bytes")]]
)
READ = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "n_tokens", "ids_crc32")])


def opened(uri: str):
    """(file system, path) of a URI; Hadoop writes file:/x for file:///x."""
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))


def _sum(data: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


def _skippable(magic: int, payload: bytes) -> bytes:
    return struct.pack("<II", magic, len(payload)) + payload


class Writer:
    """Writes one file; documents come in order as (doc_id or None, ids as little-endian unsigned 32-bit)."""

    def __init__(self, out, width: int, frame_ids: int = FRAME_IDS):
        import zstandard

        self.out, self.width, self.frame_ids = out, width, frame_ids
        self.compress = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress
        self.pending: list[bytes] = []
        self.waiting = 0
        self.doc_ids: list[int] = []
        self.nulls: list[int] = []
        self.lengths: list[int] = []
        self.frame_docs: list[int] = []
        self.seek: list[tuple[int, int, int]] = []
        self.bytes = 0

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.lengths.append(len(ids) // 4)
        self.pending.append(ids)
        self.waiting += len(ids) // 4
        if self.waiting >= self.frame_ids:
            self._frame()

    def _frame(self) -> None:
        raw = np.frombuffer(b"".join(self.pending), "<u4").astype(f"<u{self.width}").tobytes()
        packed = self.compress(raw)
        self._write(packed)
        self.seek.append((len(packed), len(raw), _sum(raw)))
        self.frame_docs.append(len(self.pending))
        self.pending, self.waiting = [], 0

    def close(self) -> None:
        if self.pending:
            self._frame()
        columns = [np.array(c, "<i8").tobytes() for c in (self.doc_ids, self.lengths, self.frame_docs)]
        head = struct.pack("<IQQ", self.width, len(self.doc_ids), len(self.frame_docs))
        index = _skippable(SKIPPABLE_INDEX, head + self.compress(b"".join([*columns, bytes(self.nulls)])))
        self._write(index)
        table = [*self.seek, (len(index), 0, _sum(b""))]
        entries = b"".join(struct.pack("<III", *entry) for entry in table)
        self._write(_skippable(SKIPPABLE_SEEK, entries + struct.pack("<IBI", len(table), CHECKSUMS, SEEKABLE)))


class Reader:
    """Reads a file given as an open seekable source of `size` bytes."""

    def __init__(self, source, size: int):
        import zstandard

        self.source, self.unpack = source, zstandard.ZstdDecompressor().decompress
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("no seek table")
        table = np.frombuffer(self._at(size - 9 - 12 * frames, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.sizes, self.sums = table[:-1, :2], table[:-1, 2]
        self.begins = np.concatenate([[0], np.cumsum(table[:, 0])])
        index = self._at(int(self.begins[-2]) + 8, int(table[-1, 0]) - 8)
        self.width, docs, data_frames = struct.unpack("<IQQ", index[:20])
        columns = self.unpack(index[20:])
        longs = np.frombuffer(columns[: 8 * (2 * docs + data_frames)], "<i8")
        self.doc_ids, self.lengths, self.frame_docs = np.split(longs, [docs, 2 * docs])
        self.nulls = np.frombuffer(columns[8 * len(longs) :], np.uint8).astype(bool)

    def _at(self, begin: int, n: int) -> bytes:
        self.source.seek(begin)
        return self.source.read(n)

    def frame(self, k: int) -> np.ndarray:
        raw = self.unpack(self._at(int(self.begins[k]), int(self.sizes[k, 0])))
        if _sum(raw) != self.sums[k]:
            raise ValueError(f"frame {k} has another checksum")
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4")

    def documents(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int, int | None, np.ndarray]]:
        """(place in the file, doc_id, ids) of all documents or those wanted; other frames are not read."""
        keep = np.ones(len(self.doc_ids), bool) if wanted is None else np.isin(self.doc_ids, list(wanted)) & ~self.nulls
        last = np.cumsum(self.frame_docs)
        for k, (begin, end) in enumerate(zip(last - self.frame_docs, last, strict=True)):
            if not keep[begin:end].any():
                continue
            ids, ends = self.frame(k), np.cumsum(self.lengths[begin:end])
            for i in np.flatnonzero(keep[begin:end]):
                at = begin + i
                yield int(at), None if self.nulls[at] else int(self.doc_ids[at]), ids[ends[i] - self.lengths[at] : ends[i]]


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    for batch in batches:
        for i in range(0, batch.num_rows, BATCH_DOCS):
            some = batch.slice(i, BATCH_DOCS)
            yield some["doc_id"].to_pylist(), some["text"].to_pylist()


def write(docs: DataFrame, tokenizer: str, end: int, folder: str | None = None) -> DataFrame:
    """Writes the ids of every text, each with `end` after it, in ascending doc_id order; returns the shards.

    A null text is empty and has only `end`; null ids come first, rows with equal ids follow each other by a hash of the
    text and are dealt like any others, however many they are. Very long texts are encoded whole. An empty table makes
    no file. Other columns are left out. A task writes its file under a name of its own and names
    it last, in the list of shards; files of lost attempts are in no list. `folder`: a URI that pyarrow opens and all
    executors share, else a new one beside the checkpoints.
    """
    folder = folder or scratch_path(docs.sparkSession, "token-store")

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        fs, base = opened(folder)
        fs.create_dir(base, recursive=True)
        part, writer, out = TaskContext.get().partitionId(), None, None
        path = f"{base}/part-{part:06d}-{uuid.uuid4().hex}.zst"
        for ids, texts in _rows(batches):
            if writer is None:
                out = fs.open_output_stream(path, compression=None)
                writer = Writer(out, 2 if max(encode.vocabulary, end + 1) <= 1 << 16 else 4)
            for doc_id, data in zip(ids, encode.texts(texts, end), strict=True):
                writer.add(doc_id, data)
        if writer is not None:
            writer.close()
            out.close()
            shard = Shard(part, path, len(writer.lengths), sum(writer.lengths), len(writer.frame_docs), writer.bytes)
            yield pa.RecordBatch.from_pylist([shard._asdict()], SHARD_ARROW)

    rows = documents(docs).withColumns({"hash_": F.xxhash64("text"), "place_": F.monotonically_increasing_id()})
    order = ("doc_id", "hash_", "place_")
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    listed = stored(ordered.mapInArrow(shards, SHARD), "shards")
    scheme = re.match(r"([^:/]+):", folder)
    if scheme and scheme[1] != "file":
        authority = re.match(r"[^:]+://[^/]*", folder)
        listed = listed.withColumn("path", F.concat(F.lit(authority[0] if authority else ""), "path"))
    else:
        listed = listed.withColumn("path", F.concat(F.lit("file://"), "path"))
    return listed


def positions(shards: DataFrame) -> DataFrame:
    """Adds start, the number of ids in the shards before; there is one row for each file."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_back(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist(), strict=True):
                fs, at = opened(path)
                with fs.open_input_file(at) as source:
                    rows = []
                    for _, doc_id, ids in Reader(source, source.size()).documents():
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids)))
                        start += len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=READ)

    files = max(1, min(shards.count(), 10_000))
    placed = positions(shards).select("path", "start").repartition(files, "path")
    return placed.mapInArrow(check, "doc_id long, start long, n_tokens long, ids_crc32 long")
