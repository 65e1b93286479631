"""Encoding and decoding with merge-type SentencePiece vocabularies, compared with the sentencepiece library.

An agenda holds each two neighbouring symbols, at first characters, whose concatenation is a piece, by score, then
place; the best is taken and merged, and the new neighbours enter the agenda, until it is empty. Long segments of a
text have a heap as agenda. Short ones are merged many at a time: a row of a matrix is the agenda of one segment.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import heapq
import itertools
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scoreloom.llm.common import documents

#: Stands for a space in pieces.
SPACE = "▁"
#: Short segments that a worker remembers; texts, and characters about, that it holds at once.
CACHED = 1_000_000
BATCH_DOCS, BATCH_CHARS = 1_024, 4_000_000
#: Symbols of a short segment at most, segments merged at a time, and the rank of two symbols that make no piece.
SHORT, ROWS, NONE = 32, 20_000, np.iinfo(np.int32).max
#: Fixed values of the model format: numbers of its fields, and the merge type.
TRAINER, NORMALIZER, MODEL_TYPE, SUFFIX, BYTES, CHARSMAP, PREFIX, TRIM, ESCAPE, MERGES = 2, 3, 3, 24, 35, 2, 3, 4, 5, 2

RESULT = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, agrees boolean"
RESULT_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("agrees", pa.bool_())]
)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or number()
        yield key >> 3, data[at : at + size]
        at += size


class Pieces:
    """A vocabulary of merges: text to ids and back.

    Only vocabularies of the merge type without user-defined or unused pieces and without a table of character
    replacements are taken; others raise ValueError.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self.library
        parts = dict(_fields(model.serialized_model_proto()))
        trainer, normalizer = dict(_fields(parts[TRAINER])), dict(_fields(parts[NORMALIZER]))
        n = model.vocab_size()
        kinds = [
            "control" if model.is_control(i) else "byte" if model.is_byte(i) else "unknown" if model.is_unknown(i) else "piece"
            for i in range(n)
        ]
        names = [model.id_to_piece(i) for i in range(n)]
        if trainer.get(MODEL_TYPE, 1) != MERGES or trainer.get(SUFFIX, 0) or normalizer.get(CHARSMAP):
            raise ValueError(f"{path} has no plain vocabulary of merges")
        if any(model.is_unused(i) for i in range(n)) or self._user_defined(model):
            raise ValueError(f"{path} has unused or user-defined pieces")
        self.prefix, self.trim = bool(normalizer.get(PREFIX, 1)), bool(normalizer.get(TRIM, 1))
        self.space = SPACE if normalizer.get(ESCAPE, 1) else " "
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.ids = {name: i for i, (name, kind) in enumerate(zip(names, kinds, strict=True)) if kind == "piece"}
        self.scores = {name: model.get_score(i) for name, i in self.ids.items()}
        byte_ids = [i for i, kind in enumerate(kinds) if kind == "byte"]
        self.byte_ids = byte_ids if trainer.get(BYTES, 0) and len(byte_ids) == 256 else []
        self.is_byte = np.zeros(n, bool)
        self.is_byte[byte_ids] = True
        self.kinds = kinds
        surface = {"control": lambda s: b"", "unknown": lambda s: " ⁇ ".encode(), "byte": lambda s: bytes([int(s[1:-1], 16)])}
        self.surfaces = [
            surface[kind](name) if kind in surface else name.replace(SPACE, " ").encode()
            for name, kind in zip(names, kinds, strict=True)
        ]
        self.led = [name.startswith(SPACE) for name in names]
        # Texts may be cut where no merge can cross: around characters that are in no piece (line ends, say), and before
        # a space after another character if no piece has that.
        inside = set().union(*self.ids)
        bare = "".join(re.escape(c) for c in map(chr, range(128)) if c not in inside)
        run = re.escape(self.space)
        rest = f"[^{bare}]+" if bare else "(?s:.)+"
        if not any(self.space in name.lstrip(self.space) for name in self.ids):
            rest = f"{run}*[^{run}{bare}]+|{run}+"
        self.segments = re.compile(f"[{bare}]|{rest}" if bare else rest)
        self.known: dict[str, bytes] = {}
        #: A character that stands alone, after which the library encodes a segment as within a text.
        self.lead = next((c for c in map(chr, range(128)) if c not in inside), "") if self.prefix and not self.trim else ""
        self.odd: set[str] = set()
        self._ranked()

    def _ranked(self) -> None:
        """Tables of the matrix agendas: ids of characters, and for two ids the rank of their score and the id they make."""
        self.of_char = np.full(sys.maxunicode + 1, -1, np.int32)
        for name, i in self.ids.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        levels = {score: rank for rank, score in enumerate(sorted(set(self.scores.values()), reverse=True))}
        pairs = sorted(
            (self.ids[name[:at]] * len(self.kinds) + self.ids[name[at:]], levels[self.scores[name]], i)
            for name, i in self.ids.items()
            for at in range(1, len(name))
            if name[:at] in self.ids and name[at:] in self.ids
        )
        self.pairs, self.ranks, self.made = (np.array(c, np.int64) for c in zip(*pairs, strict=True))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, id that they make) of neighbours; negative ids make nothing."""
        key = left.astype(np.int64) * len(self.kinds) + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        found = (self.pairs[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.ranks[at], NONE).astype(np.int32), self.made[at]

    def _short(self, segments: list[str]) -> None:
        """Ids of short segments into the memory."""
        sizes = np.array([len(s) for s in segments])
        chars = self.of_char[np.frombuffer("".join(segments).encode("utf-32-le"), "<u4")]
        inside = np.arange(sizes.max() + 1) < sizes[:, None]
        symbols = np.full(inside.shape, -1, np.int32)
        symbols[inside] = chars
        strange = ((symbols < 0) & inside).any(1)
        agenda = np.full(inside.shape, NONE, np.int32)
        agenda[:, :-1] = self._rank(symbols[:, :-1], symbols[:, 1:])[0]
        row = np.flatnonzero(~strange)
        while len(row):
            best = agenda[row].argmin(1)
            row, best = (x[agenda[row, best] < NONE] for x in (row, best))
            if not len(row):
                break
            column = np.arange(inside.shape[1] - 1)
            for table, empty in ((symbols, -1), (agenda, NONE)):
                part = table[row]
                if table is symbols:
                    part[np.arange(len(row)), best] = self._rank(part[np.arange(len(row)), best], part[np.arange(len(row)), best + 1])[1]
                part[:, :-1] = np.where(column > best[:, None], part[:, 1:], part[:, :-1])
                part[:, -1] = empty
                table[row] = part
            # Where the right symbol stood, what followed it stands now.
            agenda[row, best] = self._rank(symbols[row, best], symbols[row, best + 1])[0]
            left = best > 0
            agenda[row[left], best[left] - 1] = self._rank(symbols[row[left], best[left] - 1], symbols[row[left], best[left]])[0]
        counts = (symbols >= 0).sum(1)
        data, ends = symbols[symbols >= 0].astype("<u4").tobytes(), 4 * np.cumsum(counts)
        for segment, begin, end, odd in zip(segments, (ends - 4 * counts).tolist(), ends.tolist(), strange.tolist(), strict=True):
            self.known[segment] = self._segment(segment) if odd else data[begin:end]

    @staticmethod
    def _user_defined(model) -> bool:
        """Whether a piece of the kind "user-defined" is in the vocabulary."""
        pieces = (dict(_fields(value)) for number, value in _fields(model.serialized_model_proto()) if number == 1)
        return any(piece.get(3, 1) == 4 for piece in pieces)

    def merged(self, segment: str) -> list[str]:
        """The symbols that are left when the agenda is empty."""
        symbols: list[str] = list(segment)
        before = list(range(-1, len(symbols) - 1))
        after = [*range(1, len(symbols)), -1]
        scores, agenda = self.scores, []

        def propose(left: int, right: int) -> None:
            if left >= 0 and right >= 0 and (score := scores.get(symbols[left] + symbols[right])) is not None:
                agenda.append((-score, left, right, len(symbols[left]) + len(symbols[right])))

        for i in range(len(symbols) - 1):
            propose(i, i + 1)
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            if not symbols[left] or not symbols[right] or len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = after[right]
            if after[right] >= 0:
                before[after[right]] = left
            waiting, agenda = agenda, []
            propose(before[left], left)
            propose(left, after[left])
            for entry in agenda:
                heapq.heappush(waiting, entry)
            agenda = waiting
        return [s for s in symbols if s]

    def _segment(self, segment: str) -> bytes:
        out: list[int] = []
        for symbol in self.merged(segment):
            if (i := self.ids.get(symbol)) is not None:
                out.append(i)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in symbol.encode()]
            else:
                out.append(self.unknown)
        return np.array(out, "<u4").tobytes()

    def normal(self, text: str) -> str:
        if self.trim:
            text = re.sub(" +", " ", text.replace(SPACE, " ")).strip(" ")
        if not text:
            return ""
        return (" " * self.prefix + text).replace(" ", self.space)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids with those of begin and end, little-endian unsigned 32-bit."""
        cut = [self.segments.findall(self.normal(text)) for text in texts]
        if len(self.known) > CACHED:
            self.known.clear()
        new = sorted(set().union(*cut).difference(self.known), key=len)
        short = bisect.bisect_right(new, SHORT, key=len)
        for at in range(0, short, ROWS):
            self._short(new[at : min(short, at + ROWS)])
        long = {segment: self._segment(segment) for segment in new[short:]}
        if self.lead:
            self._compare(new, long)
        return [self._whole(segments, long) for segments in cut]

    def _compare(self, segments: list[str], long: dict[str, bytes]) -> None:
        """Segments that are new here, as the library encodes them; those that differ are kept in `odd`."""
        before = len(self.library.encode(self.lead))
        for at in range(0, len(segments), ROWS):
            some = segments[at : at + ROWS]
            # The library puts a space before a text, which is the segment's own if it has one.
            given = [x[1:] if x.startswith(self.space) else self.lead + x for x in some]
            wanted = self.library.encode(given, num_threads=1)
            wanted = [w if x.startswith(self.space) else w[before:] for x, w in zip(some, wanted, strict=True)]
            ours = [long[x] if x in long else self.known[x] for x in some]
            sizes = [4 * len(w) for w in wanted]
            whole = np.fromiter(itertools.chain.from_iterable(wanted), "<u4", sum(sizes) // 4).tobytes()
            if list(map(len, ours)) != sizes or b"".join(ours) != whole:
                self.odd.update(x for x, o, w in zip(some, ours, wanted, strict=True) if o != np.array(w, "<u4").tobytes())

    def agree(self, texts: list[str], ids: list[np.ndarray], decoded: list[str]) -> list[bool]:
        """Whether the library gives each text's ids, and for these the decoded text.

        A text's segments have been compared when they were new; the first text here, texts with a segment that differs,
        and all texts of vocabularies whose segments can't be given alone are encoded whole.
        """
        theirs = self.library.decode([i.tolist() for i in ids], num_threads=1) if texts else []
        same = [a == b for a, b in zip(decoded, theirs, strict=True)]
        for k, text in enumerate(texts):
            if k == 0 or not self.lead or self.odd and not self.odd.isdisjoint(self.segments.findall(self.normal(text))):
                same[k] &= ids[k].tolist() == self.library.encode(text, add_bos=True, add_eos=True)
        return same

    def _whole(self, segments: list[str], long: dict[str, bytes]) -> bytes:
        known = self.known
        ids = b"".join([long[s] if s in long else known[s] for s in segments] if long else map(known.__getitem__, segments))
        if not self.byte_ids and self.unknown.to_bytes(4, "little") in ids:
            array = np.frombuffer(ids, "<u4")  # a run of unknown characters is one id
            ids = array[~((array == self.unknown) & (np.append(-1, array[:-1].astype(np.int64)) == self.unknown))].tobytes()
        return self.begin.to_bytes(4, "little") + ids + self.end.to_bytes(4, "little")

    def decode(self, ids: np.ndarray) -> str:
        """The text of any ids; bytes that are no UTF-8 become U+FFFD each."""
        numbers = ids.tolist()
        parts = list(map(self.surfaces.__getitem__, numbers))
        first = next((k for k, i in enumerate(numbers) if self.kinds[i] != "control"), None)
        if first is not None and self.led[numbers[first]] and (self.prefix or self.trim):
            parts[first] = parts[first][1:]
        is_byte = self.is_byte[ids]
        if not (is_byte.any() and "control" in {self.kinds[i] for i in numbers[1:-1]}):  # such an id ends a run of bytes
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        edges = np.flatnonzero(np.diff(is_byte)) + 1
        runs = zip([0, *edges.tolist()], [*edges.tolist(), len(numbers)], strict=True)
        return "".join(_lenient(b"".join(parts[a:b])) if is_byte[a] else b"".join(parts[a:b]).decode() for a, b in runs)


def _lenient(data: bytes) -> str:
    out, at = [], 0
    while at < len(data):
        for size in (1, 2, 3, 4):
            try:
                out.append(data[at : at + size].decode())
                at += size
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


@functools.cache
def pieces(path: str) -> Pieces:
    """One vocabulary for each process, so that its segments live as long as the worker."""
    return Pieces(path)


def _some(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Rows a few at a time, by number and by characters, so that very long texts are not held with many others."""
    ids, texts, held = [], [], 0
    for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
        ids.append(doc_id.as_py())
        texts.append(text.as_py())
        held += len(texts[-1])
        if len(texts) >= BATCH_DOCS or held >= BATCH_CHARS:
            yield ids, texts
            ids, texts, held = [], [], 0
    if texts:
        yield ids, texts


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, agrees) for every row of (doc_id, text, ...).

    Ids are those of the whole text between those of begin and end, hashed as little-endian unsigned 32-bit integers;
    the decoded text is made from these ids. In each Arrow batch the sentencepiece library encodes every segment that is
    new, and the first text whole, and decodes all ids; `agrees` says that ids and text are the same. A null text is empty and has the two ids only; very long texts are
    taken whole; repeated rows have equal results; null ids stay; an empty table gives no rows. Other columns are left
    out. `path` must be there on all executors.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(path)
        for batch in batches:
            for ids, texts in _some(batch):
                ours = [np.frombuffer(data, "<u4") for data in model.encode(texts)]
                back = [model.decode(o) for o in ours]
                agrees = model.agree(texts, ours, back)
                sums = [hashlib.sha256(o.tobytes()).hexdigest() for o in ours]
                decoded = [hashlib.sha256(b.encode()).hexdigest() for b in back]
                columns = [ids, [len(o) for o in ours], sums, decoded, agrees]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT_ARROW, strict=True)], schema=RESULT_ARROW)

    return documents(docs).mapInArrow(rows, RESULT)


def decoded(rows: DataFrame, path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """`rows` with column `into`, the text of the array of ids in `ids`; a null array gives null, an empty one an empty text."""
    from scoreloom.llm.common import name

    @F.pandas_udf("string")
    def text(arrays):
        model = pieces(path)
        return arrays.map(lambda a: None if a is None else model.decode(np.asarray(a, np.int64)))

    return rows.withColumn(into, text(name(ids).cast("array<long>")))
