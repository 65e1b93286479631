import hashlib
import re

import pytest

from scoreloom.llm import licenses, pii, url_filter
from scoreloom.llm.queries import URL_RULES

URLS = [
    "https://www.Example.ORG/es/1?x=/en/", "http://example.org/en/1", "http://example.org/en/15#a", "http://a.b.example.org/fr/", "http://org/", "http://forg/x",
    "https://x.com/fr/2", "https://x.com/de/2", "https://x.com", "ftp://x.com?y://z.org/", "no scheme", None, "", "://", "http://x.net/fr/", "http://example.org", "HTTP://EXAMPLE.ORG/ES/",
    "http://example.org:80/es/", "http://example.org/es", "http://a\nb.org/\nes/", "http://x.org/a://b.com/fr/",
]


def plain_url(url):
    rest = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), v == "block", h + p, v) for h, p, v in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    rule, verdict = max(fits)[2:] if fits else (None, "allow")
    return host, path, rule, verdict


def pages(spark):
    rows = [(i, u, "x", "x", "x", "x") for i, u in enumerate(URLS + URLS[:3])]
    return spark.createDataFrame(rows, "page_id long, url string, host string, rule string, verdict string, html string")


def results(df):
    return sorted((r.page_id, r.host, r.path, repr(r.rule), r.verdict) for r in df.collect())


def test_urls_match_plain_program(spark, monkeypatch):
    want = sorted((i, h, p, repr(r), v) for i, (h, p, r, v) in enumerate(map(plain_url, URLS + URLS[:3])))
    df = pages(spark)
    assert results(url_filter.judged(df, URL_RULES)) == want
    monkeypatch.setattr(url_filter, "MAX_BROADCAST_CHARS", 0)
    assert results(url_filter.judged(df, URL_RULES)) == want


def test_longest_match_and_ties():
    entries = [("", "", "allow"), ("com", "", "block"), ("a.com", "/x", "allow"), ("com", "/x/yy", "block"), ("com", "/x/yy", "allow"), ("a.com", "/x/", "block")]
    root = url_filter.build(entries)
    assert url_filter.match(root, "b.net", "/") == ("", "allow")
    assert url_filter.match(root, "b.com", "/x") == ("com", "block")
    assert url_filter.match(root, "z.a.com", "/xx") == ("a.com/x", "allow")
    assert url_filter.match(root, "a.com", "/x/yyz") == ("com/x/yy", "block")
    assert url_filter.match(root, "a.com", "/x/q") == ("a.com/x/", "block")


def test_urls_empty(spark):
    assert url_filter.judged(pages(spark).limit(0), URL_RULES).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_pii(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    spans = [("email", m.span()) for m in EMAIL.finditer(text)]
    spans += [("ip", m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in digits(m[0])]
        odd, even = d[-1::-2], d[-2::-2]
        if 14 <= len(d) <= 19 and (sum(odd) + sum(sum(divmod(2 * x, 10)) for x in even)) % 10 == 0:
            spans.append(("card", m.span()))
    spans += [("phone", m.span()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    order = ["email", "ip", "card", "phone"]
    spans.sort(key=lambda s: (s[1][0], order.index(s[0])))
    return [sum(k == o for k, _ in spans) for o in order], ",".join(f"{k}:{b}:{e}" for k, (b, e) in spans)


PII = [
    "mail a.b@c.de and x@y, q@r.s_t@u.v.w a@b.c@d.e @@ a@@b.c @x.y", "1.2.3.4 256.1.1.1 1.2.3 1.2.3.4.5.6.7.8 0001.2.3.4 9999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 378282246310005", "call +1 (555) 123-4567 or +49.30.1234567 or +1 or +1((((((2 +1 555+1 555 123 4567",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432 and DE88 3704 0044 0532 0130 00", "SSN 123-45-6789 but order 123-45-6789x plain 987-65-4321",
    "phone (212) 555-0100 \U0001f600 a@b.cd", "1" * 30_000, "a" * 30_000 + "@", "+" * 3000 + "1(" * 3000, "a.b@" * 5000, "1." * 9000, "٣٤ ４１１１ K@k.com",
]


def test_base_spans_match_the_plain_expressions():
    for text in PII:
        found = pii.find(text)
        base = [s for s in found if s.kind in pii.BASE]
        assert (([sum(s.kind == k for s in base) for k in pii.BASE]), pii.listed(base)) == plain_pii(text)


def test_checks_and_context():
    kinds = lambda t: [s.kind for s in pii.find(t)]
    assert kinds(PII[4]).count("iban") == 2
    assert kinds("my SSN is 123-45-6789") == ["ssn"] and kinds("lot 123-45-6789 of wood") == []
    near, far = pii.find("credit card 4111111111111111")[0], pii.find("4111111111111111")[0]
    assert near.score > far.score
    text = "to a@b.cd, card 4111 1111 1111 1111!"
    assert pii.redact(text, pii.find(text)) == "to [EMAIL], card [CARD]!"


def test_pii_over_rows(make, edge, edge_rows, empty):
    rows = edge_rows + [(200 + i, t, "en", "a") for i, t in enumerate(PII)]
    got = sorted(repr((r.doc_id, [r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256)) for r in pii.detected(make(rows)).collect())
    want = []
    for i, t, *_ in rows:
        counts, listed = plain_pii(t or "")
        want.append(repr((i, counts, hashlib.sha256(listed.encode()).hexdigest())))
    assert got == sorted(want)
    out = pii.redacted(edge)
    assert out.columns == edge.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, edge.collect()))  # clean texts and nulls stay
    assert pii.detected(empty).count() == 0 and pii.redacted(empty).count() == 0


def plain_phrases(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        own = phrase.split()
        for i in range(len(words)):
            if words[i : i + len(own)] == own:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


NOTICES = [
    "x MIT License MIT license, cc-by cc by Apache\nLicense GNU General Public License", "Kit licenſe mit éapache license", "mit mit license apache",
    *[f"Some code.\n{t.text}\nMore." for t in licenses.TEMPLATES],
    "Permission is hereby granted, free of cost, to any person who obtains a copy of this software and associated documentation files (the Software), to deal in the Software without any restriction whatsoever",
    "Redistribution and use in source and binary forms, with or without modification, are not permitted",
]


def test_licenses(make, edge_rows, empty):
    rows = edge_rows + [(300 + i, t, "en", "a") for i, t in enumerate(NOTICES)]
    got = licenses.scanned(make(rows)).collect()
    want = sorted(repr((i, *plain_phrases(t))) for i, t, *_ in rows)
    assert sorted(repr((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in got) == want
    by_id = {r.doc_id: r for r in got}
    for i, t in enumerate(licenses.TEMPLATES):
        r = by_id[303 + i]
        assert t.label in r.labels.split(","), t
        assert r.score == 1.0
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 for r in got)
    assert by_id[303 + len(licenses.TEMPLATES) + 1].labels == ""  # its key phrase does not stand there
    assert all(by_id[i].labels == "" for i in range(60))
    assert licenses.scanned(empty).count() == 0


def test_notices_in_a_third_of_the_texts(make, edge_rows):
    notices = [t for t in licenses.TEMPLATES if t.label in ("mit", "bsd", "mpl", "all-rights-reserved")]
    rows = [(i, notices[i % len(notices)].text, "en", "a") for i in range(30)]
    got = {r.doc_id: (r.labels, r.score) for r in licenses.scanned(make(rows + [(100 + r[0], *r[1:]) for r in edge_rows[:60]])).collect()}
    assert all(got[i] == (notices[i % len(notices)].label, 1.0) for i in range(30))
    assert all(got[100 + r[0]][0] == "" for r in edge_rows[:60])


def test_several_licences_in_one_text(make, edge_rows):
    by = {t.label: t.text for t in licenses.TEMPLATES}
    files = [("bsd", "all-rights-reserved"), ("mit", "cc-by-sa", "mpl", "all-rights-reserved"), tuple(sorted(by))]
    rows = [(300 + i, "Copyright 2020. " + " ".join(by[x] for x in labels), "en", "a") for i, labels in enumerate(files)]
    got = {r.doc_id: r.labels.split(",") for r in licenses.scanned(make(edge_rows + rows)).collect()}
    assert all(set(labels) <= set(got[300 + i]) for i, labels in enumerate(files))


def test_rare_words_when_all_texts_are_notices(make):
    rows = [(i, licenses.TEMPLATES[0].text, "en", "a") for i in range(20)]
    assert {(r.labels, r.score) for r in licenses.scanned(make(rows)).collect()} == {("gpl", 1.0)}


def with_words(text, n, at):
    words = text.split()
    return " ".join([*words[:at], *["zzz"] * n, *words[at:]])


def key_words(template):
    """Places of the words of key phrases."""
    return {i for places in licenses._key_places(template) for i in places}


@pytest.mark.parametrize("n", [1, 3])
def test_words_put_into_notices_or_left_out(make, edge_rows, n):
    """At each place that does not part a key phrase; and each other word of a long notice left out."""
    rows, wanted = [], {}

    def add(label, words):
        i = 1000 + len(rows)
        rows.append((i, f"Some words. {' '.join(words)} More words.", "en", "a"))
        wanted[i] = label

    for t in licenses.TEMPLATES:
        words, keys = licenses._split(t.text), licenses._key_places(t)
        for at in range(1, len(words)):
            if not any(at in range(k[1], k[-1] + 1) for k in keys):
                add(t.label, [*words[:at], *["zzz"] * n, *words[at:]])
        for at in range(len(words)):
            if len(words) > 12 and at not in key_words(t):
                add(t.label, words[:at] + words[at + 1 :])
    got = {r.doc_id: r.labels.split(",") for r in licenses.scanned(make(edge_rows + rows)).collect()}
    assert len(wanted) > 200 and {rows[i - 1000][1]: label for i, label in wanted.items() if label not in got[i]} == {}


def test_key_phrases_stand_whole_in_the_same_window(make, edge_rows):
    by = {t.label: t.text for t in licenses.TEMPLATES}
    body = "in source and binary forms, with or without modification, are permitted provided that the"
    far = f"Redistribution and use. The following conditions are met? {'other words here ' * 20} {body} terms hold."
    rows = [(900, far), (901, by["bsd"]), (902, by["lgpl"]), (903, "All the rights we have are reserved."), (904, "Released under the MIT style License.")]
    got = {r.doc_id: r.labels for r in licenses.scanned(make(edge_rows + [(*r, "en", "a") for r in rows])).collect()}
    assert [got[i] for i, _ in rows] == ["", "bsd", "lgpl", "", ""]
