import itertools
import math
import zlib
from collections import Counter

import numpy as np

from scoreloom.llm import hmm as h


def model(states, symbols, seed):
    rng = np.random.default_rng(seed)
    norm = lambda a, axis: a / a.sum(axis, keepdims=True)
    return h.Model(norm(rng.random(states), 0), norm(rng.random(states), 0), norm(rng.random((states, states)), 1), norm(rng.random((symbols, states)), 0))


def paths(m, seq, start):
    for path in itertools.product(range(len(m.first)), repeat=len(seq)):
        p = start[path[0]] * m.emits[seq[0], path[0]]
        for t in range(1, len(seq)):
            p *= m.steps[path[t - 1], path[t]] * m.emits[seq[t], path[t]]
        yield path, p


def test_likelihood_is_the_sum_over_all_paths():
    m = model(3, 5, 0)
    seqs = [[1], [4, 0, 2], [0, 1, 2, 3, 4, 4], [2, 2]]
    got = h.likelihoods(m, [np.array(s, np.uint16).tobytes() for s in seqs])
    want = [math.log10(sum(p for _, p in paths(m, s, m.first))) for s in seqs]
    assert np.allclose(got, want)


def test_expected_counts_are_those_over_all_paths(monkeypatch):
    monkeypatch.setattr(h, "SEGMENT", 4)
    m, seqs = model(2, 4, 1), [[1], [3, 0, 2], [0, 1, 2, 3, 1, 1, 0], [2, 2, 0, 1]]
    total = None
    for part in h._segments([np.array(s, np.uint16).tobytes() for s in seqs]):
        found = h.expected(m, *part)
        total = found if total is None else h.Model(*(a + b for a, b in zip(total, found, strict=True)))
    want = h.Model(*(np.zeros_like(a) for a in m))
    for seq in seqs:
        for at in range(0, len(seq), 4):
            part, start = seq[at : at + 4], m.later if at else m.first
            whole = sum(p for _, p in paths(m, part, start))
            for path, p in paths(m, part, start):
                (want.later if at else want.first)[path[0]] += p / whole
                for t, s in enumerate(path):
                    want.emits[part[t], s] += p / whole
                    if t:
                        want.steps[path[t - 1], s] += p / whole
    assert all(np.allclose(a, b) for a, b in zip(total, want, strict=True))


def plain(rows):
    out, counts = [], Counter()
    for i, t, *_ in rows:
        words = (t or "").encode().lower().split() + [b""]
        held = zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2
        out.append((i, held, words))
        if not held:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    return [(i, held, len(w), sum(counts[x] > 0 for x in w), n, round(sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w), 6)) for i, held, w in out]


def test_base_matches_plain_program(edge, edge_rows, empty, monkeypatch):
    monkeypatch.setattr(h, "KNOWN_SHARE", 1 / 200)  # so that words are joined too
    monkeypatch.setattr(h, "SYMBOL_SHARE", 1 / 100)
    got = h.scored(edge, states=3, rounds=2).collect()
    rows = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got]
    assert sorted(map(repr, rows)) == sorted(map(repr, plain(edge_rows)))
    assert all(r.score < 0 for r in got)
    again = h.scored(edge.repartition(2), states=3, rounds=2).collect()
    key = lambda r: (repr(r.doc_id), r.n_tokens, round(r.score, 4))
    assert sorted(map(key, got)) == sorted(map(key, again))
    assert h.scored(empty, states=2, rounds=1).count() == 0


def test_probabilities_of_one_word_texts_sum_to_at_most_one(make):
    rows = [(i, w, "en", "a") for i, w in enumerate("a b c a b a dd eeeeee ffffffffff g, a b".split())]
    got = h.scored(make(rows), states=2, rounds=2).collect()
    texts = {r[0]: r[1] for r in rows}
    assert sum({texts[r.doc_id]: 10**r.score for r in got}.values()) <= 1


def test_better_than_single_words_on_held_out_texts(make):
    rng = np.random.default_rng(3)
    pools = [[f"{p}{i}" for i in range(30)] for p in "abc"]
    rows = [(i, " ".join(rng.choice(pools[i % 3], 60)), "en", "a") for i in range(200)]
    got = [r for r in h.scored(make(rows)).collect() if r.held_out]
    assert got and sum(r.score for r in got) > sum(r.base_score for r in got) + 10 * len(got)
