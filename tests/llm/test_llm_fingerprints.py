import hashlib

import numpy as np

from scoreloom.llm import fingerprints as f


def same(a, b):
    return a.hex() == b.hex()


def test_order_does_not_count_and_parts_can_be_added_and_taken():
    parts = [f"paragraph {i % 7}" for i in range(40)]
    whole = f.of(parts)
    assert same(whole, f.of(parts[::-1]))
    assert same(f.of(parts[:15]) + f.of(parts[15:]), whole)
    assert same(whole - f.of(parts[:15]), f.of(parts[15:]))
    assert not same(whole, f.of([*parts[1:], "paragraph 6"]))
    assert same(f.parse(whole.hex()), whole)


def test_likeness_follows_shared_paragraphs():
    a = [f"a{i}" for i in range(400)]
    for share in (0.0, 0.25, 0.5, 0.9):
        b = a[: int(400 * share)] + [f"b{i}" for i in range(400 - int(400 * share))]
        assert abs(f.likeness(f.of(a), f.of(b)) - share) < 0.3
    assert f.likeness(f.of(a), f.of(a[::-1])) == 1.0


def test_repeated_paragraphs_count_as_often_as_they_stand():
    """Half of the paragraphs replaced: by distinct ones, by copies of one, in texts of equal or of distinct lines."""
    errors = []
    for seed in range(40):
        same, distinct = [f"line {seed}"] * 200, [f"{seed} {i}" for i in range(200)]
        for text in (same, distinct):
            for other in ([f"new {seed} {i}" for i in range(100)], [f"new {seed}"] * 100):
                errors.append(f.likeness(f.of(text), f.of(text[:100] + other)) - 0.5)
    assert np.abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.085  # a seventh of a half, and some


def test_copies_do_not_wrap_to_nothing():
    a = f.of(["x"])
    for _ in range(16):  # 65,536 copies
        a = a + a
    assert f.likeness(a, f.of(["y"])) < 0.3


def test_matches_plain_program(edge, edge_rows, empty, make):
    got = f.compared(edge).collect()
    texts = {}
    for i, t, *_ in edge_rows:
        texts.setdefault(i, []).append(t or "")
    ids = sorted((i for i in texts if i is not None), reverse=True) + [None]
    assert len(got) == len(edge_rows)
    rows = {}
    for r in got:
        rows.setdefault(r.doc_id, []).append(r)
    for k, i in enumerate(ids):
        # The next row has the same id or the next lower one; which of several equal ids is by a hash.
        following = [t for t in texts[i] if len(texts[i]) > 1] + texts[ids[(k + 1) % len(ids)]]
        edits = lambda t: {t[: len(t) - len(t) // 2] + n[: len(t) // 2] for n in following}  # noqa: B023, E731
        ways = {(len(t), hashlib.sha256(e.encode()).hexdigest(), f.of(f.paragraphs(t)).hex(), f.of(f.paragraphs(e)).hex()) for t in texts[i] for e in edits(t)}
        for r in rows[i]:
            assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) in ways
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    unique = [r for r in got if r.doc_id is not None and 10 <= r.doc_id < 60]
    assert np.mean([r.near_edited for r in unique]) > np.mean([r.near_next for r in unique]) + 0.2
    assert f.compared(empty).count() == 0
    single = f.compared(make([(7, "one. two", "en", "a")])).collect()
    assert len(single) == 1 and single[0].near_next == 1.0
