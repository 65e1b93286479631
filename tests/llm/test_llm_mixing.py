import hashlib
import math
import re

import duckdb
import pytest

from scoreloom.llm import mixing as m

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows):
    """(source_size, target) by source: caps are met one after another until none is above; and keys and sizes."""
    size = [len(WORD.findall(t or "")) for _, t, _, _ in rows]
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(size, rows, strict=True) if r[3] == s) for s in sources}
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sources)}
    goal, free, left = {}, set(sources), sum(size)
    while free:
        level = left / sum(weight[s] for s in free)
        above = {s for s in free if level * weight[s] > 3 * total[s]}
        if not above:
            goal |= {s: level * weight[s] for s in free}
            break
        goal |= {s: 3 * total[s] for s in above}
        left -= sum(3 * total[s] for s in above)
        free -= above
    return size, total, goal


def check(rows, got):
    size, total, goal = plain(rows)
    taken = {}
    for r in got:
        assert r.source_size == total[r.source] and math.isclose(r.target, goal[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, n in taken.items():
        assert math.floor(goal[s]) == n or not total[s], s
    assert sorted(repr((i, n)) for (i, *_), n in zip(rows, size, strict=True)) == sorted(repr((r.doc_id, r.size)) for r in got)
    texts = {}
    for i, t, _, s in rows:
        texts.setdefault((i, s, len(WORD.findall(t or ""))), set()).add(t or "")
    for s in total:  # at most one row is taken in part, rows before it once more than rows after it
        own = []
        for r in got:
            if r.source == s and r.size and len(texts[r.doc_id, s, r.size]) == 1:
                (text,) = texts[r.doc_id, s, r.size]
                id_ = hashlib.md5(f"mix:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
                own.append((id_ + hashlib.md5(text.encode()).hexdigest(), -r.taken / r.size))
        assert sum(r.taken % r.size != 0 for r in got if r.source == s and r.size) <= 1
        times = [t for _, t in sorted(own)]
        assert times == sorted(times)


def test_matches_plain_program(edge, edge_rows):
    check(edge_rows, m.mixed(edge).collect())


@pytest.mark.parametrize("large", [1, 400])
def test_capped_sources(make, large):
    rows = [(i, "a " * n, "en", s) for i, (n, s) in enumerate([(3, "a"), (2, "b"), (10 * large, "c"), (7 * large, "c"), (5, "d"), (0, "e"), (4, None)])]
    check(rows, m.mixed(make(rows)).collect())


def test_rows_without_id_and_copies(make):
    """Half of the ids null, with equal and with other texts: one text a source is cut, the target is met."""
    rows = [(None if i % 2 else i, f"w{i} " * (i % 30) if i % 3 else "a b c d e f g", "en", "ab"[i % 5 == 0]) for i in range(600)]
    rows += [(7, "one two three four five", "en", "a")] * 300
    check(rows, m.mixed(make(rows)).collect())
    cut = [r for r in m.resampled(make(rows)).collect() if not any(r.text == t for _, t, *_ in rows)]
    assert len(cut) <= 2


def test_rows_as_the_mix_takes_them(edge, edge_rows):
    out = m.resampled(edge)
    assert out.columns == edge.columns
    words = {}
    for r in out.collect():
        n = len(WORD.findall(r.text))
        assert n and any(i == r.doc_id and (t or "").startswith(r.text) for i, t, *_ in edge_rows)
        words[r.source] = words.get(r.source, 0) + n
    taken = {}
    for r in m.mixed(edge).collect():
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert words == {s: n for s, n in taken.items() if n}


def test_reruns_agree_and_empty(edge, empty):
    a, b = (sorted(map(repr, m.mixed(edge.repartition(n)).collect())) for n in (1, 5))
    assert a == b
    assert m.mixed(empty).count() == 0 and m.resampled(empty).count() == 0


def test_sql_of_the_query(spark):
    from scoreloom.llm.queries import ORACLES, QUERIES

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = QUERIES["op8_source_mix"](spark, folder)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({ORACLES['op8_source_mix']})").fetchall()
    assert sorted(want) == sorted(map(tuple, got.collect()))
