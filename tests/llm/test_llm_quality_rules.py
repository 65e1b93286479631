import math
import random
import re
from collections import Counter

from scoreloom.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def distance(p, q):
    part = lambda x, m: x * math.log2(x / m) if x else 0.0
    return math.sqrt(max(0.0, sum(part(x, (x + y) / 2) + part(y, (x + y) / 2) for x, y in zip(p, q, strict=True)) / 2))


def brute(rows):
    """Verdicts by a plain program: key is (text, lang). Only rows that pass the base rules are references."""
    words = {t: WORD.findall(t or "") for _, t, _, _ in rows}
    stats_of = {t: plain(t) for t in words}
    failing = {t: n[0] < 20 or 100 * n[4] > 30 * n[0] for t, n in stats_of.items()}
    common, refs = {}, {}
    for lang in {r[2] for r in rows}:
        own = [w for r in rows if r[2] == lang and not failing[r[1]] for w in words[r[1]]]
        short = Counter(w for w in own if len(w) <= q.COMMON_CHARS and any(c.isalnum() for c in w))
        n = sum(short.values())
        common[lang] = [w for w, c in sorted(short.items(), key=lambda x: (-x[1], x[0])) if c >= q.COMMON_SHARE * n]

    def classes(text):
        text = text or ""
        counts = [len(re.findall(p, text)) for p in ("[#*$%&|<>]", "[0-9]", "[A-Z]")]
        return [*counts, len(text.encode()) - len(text), len(text) - sum(counts)]

    def hits(text, lang):
        counts = Counter(words[text])
        own = [counts[w] for w in common[lang]]
        return [*own, len(words[text]) - sum(own)]

    share = lambda xs: [x / sum(xs) for x in xs]
    for lang in common:
        own = [r for r in rows if r[2] == lang and not failing[r[1]]]
        total = lambda lists: [sum(x) for x in zip(*lists, strict=True)]
        refs[lang] = total([classes(r[1]) for r in own]), total([hits(r[1], lang) for r in own])
    out = []
    for i, text, lang, _ in rows:
        stats, failed = stats_of[text], failing[text]
        far, lacks = (None, None), False
        if stats[0] >= q.MIN_JUDGED_WORDS and len(text) >= q.MIN_JUDGED_CHARS and sum(refs[lang][1]) >= q.MIN_REFERENCE_WORDS:
            far = tuple(round(distance(share(a), share(b)), 6) for a, b in zip((classes(text), hits(text, lang)), refs[lang], strict=True))
            usual, found = share(refs[lang][1])[:-1], hits(text, lang)[:-1]
            expected = stats[0] * sum(usual)
            lacks = sum(found) < min(q.MIN_COMMON_SHARE * expected, expected - q.COMMON_DEVIATIONS * math.sqrt(expected))
            lacks |= stats[0] * sum(x for x, n in zip(usual, found, strict=True) if not n) > q.MAX_MISSING
        kept = not failed and not lacks and not (far[0] is not None and (far[0] > q.MAX_CLASS_DISTANCE or far[1] > q.MAX_WORD_DISTANCE))
        out.append((i, *stats, failed, *far, kept))
    return out


def test_matches_plain_program(edge, edge_rows):
    got = q.judged(edge).collect()
    rows = [
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed,
         r.class_distance, r.word_distance, r.kept)
        for r in got
    ]
    assert sorted(map(repr, rows)) == sorted(map(repr, brute(edge_rows)))


def test_filter_keeps_rows_and_columns(edge, edge_rows):
    out = q.filtered(edge)
    assert out.columns == edge.columns
    want = sorted(repr(r[:2]) for r, v in zip(edge_rows, brute(edge_rows), strict=True) if v[-1])
    assert sorted(repr((r.doc_id, r.text)) for r in out.collect()) == want


def test_junk_is_far_and_clean_text_is_kept(make, edge_rows):
    clean = [r for r in edge_rows[:60] if len((r[1] or "").split()) >= 60]
    junk = [(900, "\n".join(f"@{i}# a%{i}$ 77{i} ||| <b{i}>" for i in range(60)), "en", "a"), (901, " ".join(f"ZQ{i}X99" for i in range(90)), "de", "a")]
    verdict = {r.doc_id: r.kept for r in q.judged(make(clean + junk)).collect()}
    assert not verdict[900] and not verdict[901]
    assert all(verdict[r[0]] for r in clean)


def test_wrong_language_and_gibberish_are_not_kept(make):
    rng = random.Random(8)
    common = {"en": "the of and to in is a that".split(), "de": "der die und das den von zu in".split(), "xx": "der die und y que el los las".split()}

    def text(lang, n, share=0.16):
        return " ".join(rng.choice(common[lang]) if rng.random() < share else "".join(rng.choices("abcdefgh", k=8)) for _ in range(n))

    clean = [(i, text(lang, rng.randint(60, 400)), lang, "a") for i, lang in enumerate(["en", "de", "xx"] * 60)]
    junk = [(500 + i, "| " * 300 + text("en", 30), "en", "a") for i in range(9)]
    wrong = [(600, text("de", 120), "en", "a"), (601, text("en", 120), "de", "a"), (602, text("en", 100, 0), "en", "a"), (603, text("de", 400), "xx", "a")]
    docs = make(clean + junk + wrong)
    assert all("|" not in r.common for r in q.common_words(docs.select("text", "lang")).collect())
    verdict = {r.doc_id: r.kept for r in q.judged(docs).collect()}
    assert not any(verdict[r[0]] for r in wrong)
    assert sum(not verdict[r[0]] for r in clean) == 0


def mixed(seed, failing=0):
    """Clean, foreign and repetitive texts of two languages."""
    rng = random.Random(seed)
    common = {"en": "the of and to in is a that".split(), "de": "der die und das den von zu in".split()}

    def text(lang, n, share=0.3):
        return " ".join(rng.choice(common[lang]) if rng.random() < share else "".join(rng.choices("abcdefgh", k=8)) for _ in range(n))

    rows = [(i, text(lang, rng.randint(60, 300)), lang, "a") for i, lang in enumerate(["en", "de"] * 60)]
    rows += [(300 + i, text("de", 150), "en", "a") for i in range(5)] + [(310 + i, text("en", 120, 0), "en", "a") for i in range(5)]
    return rows + [(400 + i, "buy this now and call me at once please\n" * 200, "en", "a") for i in range(failing)]


def test_missing_common_words_as_a_plain_program(make):
    rows = mixed(3, failing=4)
    got = sorted((r.doc_id, r.base_failed, r.kept) for r in q.judged(make(rows)).collect())
    want = brute(rows)
    assert got == sorted((r[0], r[6], r[-1]) for r in want)
    assert not any(kept for i, _, kept in got if i >= 300) and all(kept for i, _, kept in got if i < 300)


def test_rejected_rows_do_not_decide_what_is_kept(make):
    """A language flooded by one repeated line, ten times as many words as all others."""
    rows = mixed(4)
    before = {r.doc_id: r.kept for r in q.judged(make(rows)).collect()}
    flood = [(1000 + i, "same old line of words that goes on and on\n" * 250, "en", "a") for i in range(120)]
    after = {r.doc_id: r.kept for r in q.judged(make(rows + flood)).collect()}
    assert all(after[i] == kept for i, kept in before.items()) and not any(after[r[0]] for r in flood)
    assert sorted(r.doc_id for r in q.filtered(make(rows + flood)).collect()) == sorted(i for i, kept in before.items() if kept)


def test_a_language_of_rejected_rows_only(make):
    rows = [(i, "same old line of words that goes on and on\n" * 50, "xx", "a") for i in range(30)]
    assert not any(r.kept for r in q.judged(make(rows)).collect()) and q.filtered(make(rows)).count() == 0


def test_empty(empty):
    assert q.judged(empty).count() == 0
    assert q.filtered(empty).count() == 0
