import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from scoreloom.llm import prefixes as p

SCHEMA = "conv_id long, turn long, role string, text string, key string, n string, prefix string"


def plain(rows):
    """Every node as a tuple, from whole paths."""
    own = {}
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        own.setdefault(conv, []).append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {c: [r[3:] for r in sorted(turns)] for c, turns in own.items()}
    paths = {}
    for c, turns in own.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        base = own.get(c - int(np.fmod(c, 20)), []) if c is not None else []
        paths[c] = (*base[:h], *turns[h:])
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    kids, leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    least = {node: min((c for c in convs if c is not None), default=None) for node, convs in members.items()}
    for node in members:
        kids[node[:-1]] += len(node) > 0
    for node, convs in members.items():
        worth = (len(convs) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += worth
            leaves[node[:d]] += kids[node] == 0
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if c is not None and len(paths[c]) == len(node))))
        above = least[node[:-1]] if node else None
        out.append((least[node], len(node), above, len(convs), kids[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(map(repr, out))


def checked(spark, rows, parts=3, **sizes):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(parts)
    assert sorted(repr(tuple(r)) for r in p.nodes(df, **sizes).collect()) == plain(rows)


def conversations(seed, convs, turns, texts, start=0):
    rng = random.Random(seed)
    return [(start + c, t, ("user", "assistant")[t % 2], rng.choice(texts)) for c in range(convs) for t in range(rng.randint(0, turns))]


TEXTS = ["a b", "c", "d  e\tf", "", "a b g"]


@pytest.mark.parametrize(("sizes", "parts"), [({}, 3), ({"most": 4, "layers": 2}, 2), ({"most": 1, "layers": 3}, 4), ({"most": 7, "layers": 1}, 3)])
def test_as_a_plain_program(spark, sizes, parts):
    rows = conversations(1, 90, 7, TEXTS) + conversations(2, 30, 12, TEXTS[:2], 200)
    checked(spark, rows, parts, **sizes)


def test_groups_of_copies_and_a_common_first_turn(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 400, 2) for t in range(4)]
    rows += [(c, t, "user", "turn 0" if t == 0 else f"own {c} {t}") for c in range(1, 300, 2) for t in range(3)]
    checked(spark, rows, 4, most=16, layers=2)


def test_long_conversations(spark):
    rows = [(c, t, "user", f"{t % 3}") for c, n in ((0, 150), (1, 150), (2, 90), (3, 200), (5, 65), (6, 64), (7, 1)) for t in range(n)]
    checked(spark, rows, 4)
    checked(spark, rows, 4, most=2, layers=8)


def test_nulls_ties_repeats_and_strange_ids(spark):
    rows = [(4, None, "user", "x"), (4, None, None, None), (4, 3, "user", "a"), (4, 3, "user", "b"), *[(4, 3, "user", "a")] * 5]
    rows += [(None, 1, "user", "x"), (None, None, "user", "y z"), (None, None, "user", "y z")]
    rows += [(-7, 1, "user", "x"), (0, 2, "user", "q"), (2**62 + 1, 5, "user", "w " * 100_000), (21, 0, "user", "gone"), (24, 0, "user", "x")]
    checked(spark, rows)
    checked(spark, rows, most=1, layers=1)
    checked(spark, [(None, 1, "user", "x")])


def test_empty_table(spark):
    assert p.nodes(spark.createDataFrame([], SCHEMA)).collect() == []


def test_double_array_holds_each_child_once():
    rng = random.Random(4)
    for _ in range(60):
        parent, symbol, nodes = [], [], [0]
        for node in nodes:
            for c in sorted(rng.sample(range(1, 60), rng.choice([0, 1, 1, 1, 2, 5, 30]) if len(nodes) < 300 else 0)):
                parent.append(node)
                symbol.append(c)
                nodes.append(len(nodes))
        trie = p.DoubleArray(np.array(parent, np.int64), np.array(symbol, np.int64))
        assert len(set(trie.slot.tolist())) == len(nodes)
        for node, (above, c) in enumerate(zip(parent, symbol, strict=True), 1):
            assert trie.step(trie.slot[[above]], np.array([c])).tolist() == [trie.slot[node]]
        children = {}
        for above, c in zip(parent, symbol, strict=True):
            children.setdefault(above, set()).add(c)
        for node in nodes:
            found = trie.step(np.full(60, trie.slot[node]), np.arange(1, 61))
            assert {int(c) for c in np.flatnonzero(found >= 0) + 1} == children.get(node, set())
