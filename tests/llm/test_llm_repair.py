import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from scoreloom.llm import repair as p

SCHEMA = "conv_id long, turn long, role string, text string, n string, kind string, costs string"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"


def key(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 4:
            role = "user"
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired) of rows (role, text, fault) by whole audits, from the last row to the first."""

    def offers(i, state):
        if i == len(rows) and state in "0a":
            yield 0, "", ()
        after = "a" if state == "u" else "u"
        full = {"u": "user", "a": "assistant"}[after]
        if i < len(rows):
            role, text, fault = rows[i]
            cost, audit, out = best(i + 1, state, 0)
            yield cost + 4, "D" + audit, out
            if fault not in ("blank", "duplicate"):
                extra = 3 if fault == "truncated" else 0
                if role[:1] == "s" and state == "0" or role[:1] == after:
                    cost, audit, out = best(i + 1, role[0], 0)
                    yield cost + extra, "K" + audit, (f"{role}:{text}", *out)
                cost, audit, out = best(i + 1, after, 0)
                yield cost + 3 + extra, "R" + audit, (f"{full}:{text}", *out)
        return after, full

    @cache
    def best(i, state, inserted):
        found = list(offers(i, state))
        if inserted < 3:
            after = "a" if state == "u" else "u"
            cost, audit, out = best(i, after, inserted + 1)
            found.append((cost + 3, "I" + audit, ({"u": "user:", "a": "assistant:"}[after], *out)))
        return min(found, default=(10**9, "", ()), key=lambda f: f[:2])

    return best(0, "0", 0)


def plain(rows, ids):
    """Rows after damage; every id of `ids` gets a result."""
    result = {}
    for conv in ids:
        mine = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, key(r[1], r[2])))
        seen, marked = set(), []
        for _, role, text in mine:
            last = text.rstrip(BLANKS)
            fault = "blank" if not last else "duplicate" if (role, text) in seen else None if last[-1] in ".!?" else "truncated"
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {t for t, *_ in mine if t is not None}
        counts = [sum(f == kind for *_, f in marked) for kind in ("blank", "duplicate", "truncated")]
        initials = [role[:1] for role, *_ in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        cost, audit, out = cheapest(marked)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        result[conv] = (conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
    return result


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def checked(spark, rows, most, parts):
    df = table(spark, rows).repartition(parts)
    found = p.audited(p.damaged(df), most).collect()
    want = plain(hurt(rows), {r[0] for r in rows})
    assert {r.conv_id: tuple(r) for r in found} == want and len(found) == len(want)


def conversations(seed, convs, turns):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randint(0, turns)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool"])
            rows.append((conv, turn, role, rng.choice(["yes.", "no!", "cut", "", " \n", "long one. ", "é?"]) + str(rng.choice(["", rng.randint(0, 99)]))))
    return rows


EDGES = [
    *[(7, t, r, x) for t, r, x in [(None, "user", "a."), (None, None, None), (3, "user", "a."), (3, "user", "b."), (3, "user", "a."), (9, "", "c.")]],
    (None, 1, "user", "a."), (None, None, "assistant", "b."), (None, 2, "system", "b. \t\n"),
    (-5, -3, "system", "s."), (-5, 4, "assistant", "x" * 200_000), (2**62, 2**62, "user", "u."),
    *[(50, t, "user", "same.") for t in range(40)], *[(51, 6, "user", "same.")] * 30,
]


@pytest.mark.parametrize(("most", "parts"), [(p.BLOCK, 3), (2, 2), (3, 5)])
def test_as_a_plain_program(spark, most, parts):
    checked(spark, [*conversations(most, 40, 9), *((100 + c, t, r, x) for c, t, r, x in conversations(1, 3, 60)), *EDGES], most, parts)


def test_one_conversation_has_most_rows(spark):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a.", "b"]) + (f" {t}." if rng.random() < 0.8 else "")) for t in range(400)]
    checked(spark, [*rows, *conversations(4, 10, 5)], 16, 4)


def test_empty_table(spark):
    assert p.audited(p.damaged(table(spark, []))).collect() == []


def test_rows_that_are_not_damaged(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "u."), (1, 2, "assistant", "a."), (2, 0, "user", "u.")]
    found = {r.conv_id: (r.cost, r.audit) for r in p.audited(p.undamaged(table(spark, rows))).collect()}
    assert found == {1: (0, "KKK"), 2: (3, "KI")}


def random_audits(rng):
    tree = p.Audits()
    for _ in range(300):
        tree.add(rng.randrange(len(tree.depth)), rng.choice("DIK"))
    return tree


@pytest.mark.parametrize("modulus", [p.MODULUS, 3])
def test_ties_by_the_common_prefix(monkeypatch, modulus):
    """With a modulus of 3 most hashes collide; letters are verified."""
    monkeypatch.setattr(p, "MODULUS", modulus)
    rng = random.Random(9)
    tree = random_audits(rng)
    for _ in range(3000):
        a, b = rng.randrange(len(tree.depth)), rng.randrange(len(tree.depth))
        assert tree.before(a, b) == (tree.text(a) < tree.text(b))


def test_blocks_put_together_are_one_block():
    rng = random.Random(8)
    for _ in range(150):
        rows = [(rng.choice(["s", "u", "a", "t", ""]), rng.choice([p.CLEAN, p.CLEAN, p.CUT_OFF, p.GONE])) for _ in range(rng.randint(0, 30))]
        whole, cut = p.Chain(), p.Chain()
        whole.add(*p.table(rows, tuple(p.STATES)))
        for at in range(0, len(rows), 4):
            cut.add(*p.table(rows[at : at + 4], tuple(p.STATES)))
        texts = {None: "clean", p.CLEAN: "clean", p.CUT_OFF: "truncated", p.GONE: "blank"}
        assert whole.end() == cut.end() == cheapest([(i, "", texts[f]) for i, f in rows])[:2]
