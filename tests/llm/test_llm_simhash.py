import numpy as np
import pytest
import xxhash

from scoreloom.llm import simhash as s


def plain(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def roots(values):
    """Smallest place that each place is linked with, by comparing all pairs."""
    values, root = np.array(values, np.uint64), list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= s.MAX_BITS):
            a, b = find(i), find(int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def crowded(rng, n):
    """Distinct values, many within a few bits of each other, in few regions."""
    centres = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    out = set(rng.integers(0, 1 << 63, n // 3, dtype=np.uint64).tolist())
    while len(out) < n:
        v = int(rng.choice(centres))
        for b in rng.integers(0, 64, int(rng.integers(0, 7))):
            v ^= 1 << int(b)
        out.add(v)
    return sorted(out)


@pytest.mark.parametrize("n", [1, 2, 50, 900])
def test_trie_join_finds_every_pair(n):
    values = np.array(crowded(np.random.default_rng(n), n), np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 2
    found = {(int(a), int(b)) for i, j in s.trie_join(values, None) for a, b in zip(i, j, strict=True)}
    assert found == {(i, j) for i, j in zip(*np.nonzero(near), strict=True) if i < j}
    a, b = values[::2], values[1::2]
    if len(b):
        found = {(int(x), int(y)) for i, j in s.trie_join(a, b) for x, y in zip(i, j, strict=True)}
        assert found == set(zip(*(x.tolist() for x in np.nonzero(np.bitwise_count(a[:, None] ^ b[None, :]) <= 2)), strict=True))


def test_cut_tries_lose_no_link(spark):
    values = crowded(np.random.default_rng(1), 700)
    signed = np.array(values, np.uint64).astype(np.int64).tolist()
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r.node: r.root for r in s.components(s.links(fps, most=40)).collect()}
    signed_order = np.array(values, np.uint64).astype(np.int64)
    want = roots(values)
    groups = {}
    for v, r in zip(signed_order.tolist(), want, strict=True):
        groups.setdefault(r, set()).add(v)
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {
        frozenset(v for v in found if found[v] == r) for r in set(found.values())
    }


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501)], "low long, high long")
    assert {r.node: r.root for r in s.components(edges).collect()} == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_matches_plain_program(edge, edge_rows):
    fps = [plain(t) for _, t, _, _ in edge_rows]
    root, least = roots(fps), {}
    for (i, *_), r in zip(edge_rows, root, strict=True):
        if i is not None:
            least[r] = min(i, least.get(r, i))
    want = sorted((repr(i), f"{fp:016x}", repr(least.get(r))) for (i, *_), fp, r in zip(edge_rows, fps, root, strict=True))
    got = sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in s.linked(edge).collect())
    assert got == want


def test_one_row_of_each_group_stays(edge, edge_rows):
    out = s.deduplicated(edge)
    assert out.columns == edge.columns
    fps = [plain(t) for _, t, _, _ in edge_rows]
    groups = {}
    for (i, *_), r in zip(edge_rows, roots(fps), strict=True):
        groups.setdefault(r, []).append(i)
    want = sorted(repr(min((i for i in g if i is not None), default=None)) for g in groups.values())
    assert sorted(repr(r.doc_id) for r in out.collect()) == want


def test_large_group_of_copies(make):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words), "en", "a") for i in range(300)] + [(1000 + i, " ".join([*words[:i], "x", *words[i + 1 :]]), "en", "a") for i in range(40)]
    found = {r.doc_id: r.component_id for r in s.linked(make(rows)).collect()}
    assert all(found[i] == 0 for i in range(300))


def test_empty(empty):
    assert s.linked(empty).count() == 0
    assert s.deduplicated(empty).count() == 0
