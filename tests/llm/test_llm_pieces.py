import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scoreloom.llm import pieces as p
from scoreloom.llm.queries import vocabulary

PARTS = [" ", "  ", "▁", "a", "the", "\n", "\t", "\x00", "é", "あ", "執", "\U0001f600", "<s>", "<unk>", "<0x0A>", "in", "er", " t", "⁇", "İ", "ﬁ"]


@pytest.fixture(scope="module")
def model():
    return p.Pieces(vocabulary())


def same(model, texts):
    for text, data in zip(texts, model.encode(texts), strict=True):
        ids = model.library.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(data, "<u4").tolist() == ids
        assert model.decode(np.array(ids)) == model.library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=9)), max_size=12))
def test_texts_as_the_library(model, parts):
    same(model, ["".join(parts).encode("utf-8", "ignore").decode()])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 270), st.integers(0, 31_999)), max_size=12))
def test_any_ids_decode_as_the_library(model, ids):
    assert model.decode(np.array(ids, np.int64)) == model.library.decode(ids)


def test_matrix_and_heap_agree(model, edge_rows):
    segments = sorted({s for _, t, *_ in edge_rows for s in model.segments.findall(model.normal(t or ""))})
    segments = [s for s in segments if len(s) <= p.SHORT]
    model.known.clear()
    model._short(segments)
    assert len(segments) > 50 and all(model.known[s] == model._segment(s) for s in segments)


def test_agenda_takes_the_best_pair_each_time(model):
    """Against a program that looks at all pairs before each merge."""
    for segment in ("▁international", "▁▁▁▁▁▁▁x", "aaaaaaaa", "▁conversations", "ofthethe"):
        symbols = list(segment)
        while best := max(((model.scores[a + b], -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if a + b in model.scores), default=None):
            i = -best[1]
            symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        assert model.merged(segment) == symbols


def test_long_runs_without_spaces(model):
    same(model, ["ab" * 3000, "執" * 500, " " * 700, "x\n" * 400, ""])


def test_a_difference_from_the_library_is_said(monkeypatch):
    """Without one of the vocabulary's pieces, texts whose ids change disagree, others don't."""
    model = p.Pieces(vocabulary())
    del model.scores["▁the"], model.ids["▁the"]
    model._ranked()
    texts = ["nothing odd", "say the word", "the", "no\nthe\nx", "x" * 99]
    ids = [np.frombuffer(d, "<u4") for d in model.encode(texts)]
    whole = [i.tolist() == model.library.encode(t, add_bos=True, add_eos=True) for i, t in zip(ids, texts, strict=True)]
    assert model.agree(texts, ids, [model.decode(i) for i in ids]) == whole and False in whole and True in whole


def test_every_row(spark, edge, edge_rows, empty, model):
    rows = p.encoded(edge, vocabulary()).collect()
    assert len(rows) == len(edge_rows) and all(r.agrees for r in rows)
    want = []
    for i, text, *_ in edge_rows:
        ids = model.library.encode(text or "", add_bos=True, add_eos=True)
        text = model.library.decode(ids)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), True))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))
    assert p.encoded(empty, vocabulary()).count() == 0


def test_decoded_column(spark, model):
    ids = [model.library.encode(t) for t in ("one two", "", "a\nb")]
    rows = spark.createDataFrame([(ids[0], "x"), (ids[1], "y"), (ids[2], "z"), (None, "n")], "ids array<int>, ids_ string")
    assert [r.text for r in p.decoded(rows, vocabulary()).collect()] == ["one two", "", "a\nb", None]

