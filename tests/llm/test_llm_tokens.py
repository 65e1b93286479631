import io
import zlib

import numpy as np
import pytest
import xxhash
import zstandard

from scoreloom.llm import packing, token_store
from scoreloom.llm.queries import END_ID, tokenizer
from scoreloom.llm.tokens import Encoder, encoder

TEXTS = ["", " \n ", "It's 3 o'clock, isn't it?", "a b c\x1cd́ é ́x", "<|endoftext|> and <|startoftext|>x", "ÀÉÎ Straße ΑΣ \U0001f600", "x" * 5000, "tab\tand\rreturn\x0bvertical\x0cform"]


def plain(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer())
    return [np.array([*t.encode(x or "", add_special_tokens=False).ids, END_ID], "<u4") for x in texts]


def test_cached_words_give_the_ids_of_whole_texts(edge_rows):
    texts = TEXTS + [t or "" for _, t, _, _ in edge_rows]
    for _ in range(2):
        assert encoder(tokenizer()).texts(texts, END_ID) == [x.tobytes() for x in plain(texts)]


def test_plain_words_are_encoded_together_and_marks_cut_off():
    texts = [
        "retreon%%% retreon,!! Retreon... aninst** zebra zebra- q qu a", "it's. don't!! x'. 'tis' rock'n'roll,",
        "foo<|endoftext|> foo<|endoftext|>. <|endoftext|>!! Foo|> foo|>", "é! eé!! é́. naïve$$ x́, x́ \x0b, a\x0b. a\xa0b.",
        "Éa Foo fOO!! I Iİ İ K S ſ", "7. a7. 7a. -- .. a-b-c.. a.b.c, " + "z" * 60 + "!! " + "y" * 60, " ".join(chr(97 + i % 26) * (i % 7 + 1) for i in range(300)),
    ]
    encode = Encoder(tokenizer())
    whole, seen = encode._encode, []
    encode._encode = lambda words: seen.extend(words) or whole(words)
    for _ in range(2):
        assert encode.texts(texts, END_ID) == [x.tobytes() for x in plain(texts)]
    assert encode.bare and not [w for w in seen if w.isascii() and w.isalpha()]
    assert not {"retreon%%%", "retreon,!!", "aninst**"} & set(seen)


@pytest.fixture(scope="module")
def ordered(edge_rows):
    place = lambda text: np.uint64(xxhash.xxh64_intdigest((text or "").encode(), 42)).astype(np.int64)
    rows = sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0, place(r[1])))
    return [(i, ids) for (i, *_), ids in zip(rows, plain([t for _, t, _, _ in rows]), strict=True)]


def test_files_read_back(edge, ordered):
    shards = token_store.write(edge, tokenizer(), END_ID)
    starts = np.cumsum([0, *(len(ids) for _, ids in ordered)])
    want = [(i, int(s), len(ids), zlib.crc32(ids)) for (i, ids), s in zip(ordered, starts, strict=False)]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in token_store.read_back(shards).collect())


def test_rows_without_id_are_dealt_to_many_files(spark, make):
    rows = [(None if i % 2 else i, f"text {i} " * 9 if i % 4 else "the same", "en", "a") for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = token_store.write(make(rows), tokenizer(), END_ID).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    docs = sorted(r.docs for r in shards)
    assert sum(docs) == len(rows) and docs[-1] <= 2 * docs[len(docs) // 2]


def test_frames_are_independent_and_only_wanted_ones_are_read(ordered):
    out = io.BytesIO()
    writer = token_store.Writer(out, 2, frame_ids=500)
    for i, ids in ordered:
        writer.add(i, ids.tobytes())
    writer.close()
    data = out.getvalue()
    reader = token_store.Reader(io.BytesIO(data), len(data))
    assert [(i, ids.tolist()) for _, i, ids in reader.documents()] == [(i, ids.tolist()) for i, ids in ordered]
    read = []
    reader.frame = lambda k, whole=reader.frame: read.append(k) or whole(k)
    assert [(i, ids.tolist()) for _, i, ids in reader.documents([50])] == [(i, ids.tolist()) for i, ids in ordered if i == 50]
    assert len(read) == 1 < len(reader.frame_docs)
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert whole == np.concatenate([ids for _, ids in ordered]).astype("<u2").tobytes()  # any zstandard reader skips the rest
    broken = bytearray(data)
    broken[20] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(token_store.Reader(io.BytesIO(bytes(broken)), len(data)).documents())


def placed_whole(pieces, ordered, capacity):
    """Every id in exactly one piece, sequences gapless and within the capacity; returns their lengths."""
    left, sequences = {}, {}
    for i, ids in ordered:
        left.setdefault(i, []).append(ids)
    spans = {}
    for p in pieces:
        spans.setdefault(p.doc_id, []).append((p.start, p.length, p.ids_crc32, p.doc_tokens))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for i, texts in left.items():
        own = sorted(spans.pop(i))
        assert sum(n for _, n, _, _ in own) == sum(map(len, texts))
        for start, n, crc, total in own:
            assert any(len(ids) == total and zlib.crc32(ids[start : start + n]) == crc for ids in texts)
    assert not spans
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at <= capacity
    return [sum(n for _, n in parts) for parts in sequences.values()]


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(edge, ordered, capacity):
    pieces = packing.packed(edge, tokenizer(), END_ID, capacity=capacity, windows=4, least=8).collect()
    lengths = placed_whole(pieces, ordered, capacity)
    assert sum(capacity - n for n in lengths if n >= capacity - 8) < 0.2 * capacity * len(lengths)
    assert sum(n < capacity - 8 for n in lengths) <= 1  # of one merging task


def test_bounded_windows():
    packer, rng = packing.Packer(100, 3, 5), np.random.default_rng(0)
    for i in range(500):
        packer.add((i, 0, bytes(4 * int(rng.integers(1, 250))), 1))
        assert len(packer.open) <= 3
    packer.merge()
    sizes = [sum(len(p[2]) // 4 for p in w) for w in packer.done]
    assert max(sizes) <= 100 and sum(s < 96 for s in sizes) <= 1


def test_empty(empty):
    assert packing.packed(empty, tokenizer(), END_ID).count() == 0
    assert token_store.read_back(token_store.write(empty, tokenizer(), END_ID)).count() == 0
