"""Personal data: expressions propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
BASE = KINDS[:4]
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match of `ip` always ends with a whole run of digits, so starting only where a run starts finds the same ones.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
LOCAL_PHONE = re.compile(r"(?<![0-9+])\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}(?![0-9-])")

#: Score of a proposal that its checks confirm, and what a word of its kind within REACH characters adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4, "local_phone": 0.6}
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("address", "host", "server", "ip"),
    "card": ("card", "visa", "credit", "payment"), "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "account", "bank"), "ssn": ("ssn", "social", "security"),
    "local_phone": ("phone", "call", "tel", "mobile", "fax"),
}
REACH, ADDED, LEAST = 40, 0.3, 0.5
DIGIT = re.compile("[0-9]")


class Span(NamedTuple):
    start: int
    kind: str
    end: int
    score: float


def luhn(digits: str) -> bool:
    doubled = (int(d) * 2 for d in digits[-2::-2])
    return (sum(map(int, digits[::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def mod97(iban: str) -> bool:
    plain = iban.replace(" ", "")
    return 15 <= len(plain) <= 34 and int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Around each @: the run of local characters before it that no match has taken, and a domain after it."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = done + len(text[done:at].rstrip(LOCAL))
        if begin < at and (m := DOMAIN.match(text, at + 1)):
            yield begin, m.end()
            done = m.end()
        else:
            done = at + 1
        at = text.find("@", done)


def _proposed(text: str) -> Iterator[tuple[str, int, int]]:
    if "@" in text:
        for begin, end in _emails(text):
            yield "email", begin, end
    if not DIGIT.search(text):
        return
    for m in IP.finditer(text):
        if all(len(g := part.lstrip("0")) <= 3 and int(g or 0) <= 255 for part in m[0].split(".")):
            yield "ip", m.start(), m.end()
    for m in CARD.finditer(text):
        if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            yield "card", m.start(), m.end()
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end()
    for m in IBAN.finditer(text):
        if mod97(m[0]):
            yield "iban", m.start(), m.end()
    for kind, pattern in (("ssn", SSN), ("local_phone", LOCAL_PHONE)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end()


def _near(text: str, kind: str, begin: int, end: int) -> bool:
    around = f"{text[max(0, begin - REACH):begin]} {text[end:end + REACH]}".lower()
    return any(word in CONTEXT[kind] for word in re.findall(r"[a-z]+", around))


def find(text: str) -> list[Span]:
    """Spans by start, then kind in the order of KINDS; offsets in code points.

    Spans of the base kinds always stay. The others stay from a score of LEAST, unless they overlap a base span.
    """
    base, more = [], []
    for kind, begin, end in _proposed(text):
        score = min(1.0, SCORES[kind] + ADDED * _near(text, kind, begin, end))
        (base if kind in BASE else more).append(Span(begin, kind, end, round(score, 3)))
    taken, reach = sorted((s.start, s.end) for s in base), []
    for _, end in taken:  # the furthest end of any span up to this one
        reach.append(max(end, reach[-1]) if reach else end)
    for s in more:
        i = bisect.bisect_left(taken, (s.end,))
        if s.score >= LEAST and not (i and reach[i - 1] > s.start):
            base.append(s)
    return sorted(base, key=lambda s: (s.start, KINDS.index(s.kind)))


def listed(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def redact(text: str, spans: list[Span]) -> str:
    """Each span, or run of overlapping spans, becomes [KIND] of its first."""
    parts, done = [], 0
    for s in spans:
        if s.start >= done:
            parts += [text[done:s.start], f"[{s.kind.upper()}]"]
        done = max(done, s.end)
    return "".join([*parts, text[done:]])


_FOUND = T.StructType(
    [T.StructField(f"n_{k}", T.LongType()) for k in BASE]
    + [T.StructField(c, T.StringType()) for c in ("base_sha256", "spans")]
    + [T.StructField("scores", T.ArrayType(T.DoubleType()))]
)


@F.pandas_udf(_FOUND)
def _found(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        spans = find(text)
        base = [s for s in spans if s.kind in BASE]
        counts = [sum(s.kind == k for s in base) for k in BASE]
        rows.append([*counts, hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), [s.score for s in spans]])
    return pd.DataFrame(rows, columns=_FOUND.names)


@F.pandas_udf(T.StringType())
def _redacted(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: text if text is None else redact(text, find(text)))


def detected(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores) for every row of (doc_id, text, ...).

    A null or empty text has no spans. Repeated rows have equal results; other columns are left out.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _found(F.coalesce(F.col("text"), F.lit(""))).alias("f"))
    return rows.select("doc_id", "f.*")


def redacted(docs: DataFrame) -> DataFrame:
    """docs with personal data replaced in `text`; a null text stays null, all columns and rows stay."""
    return docs.withColumn("text", _redacted("text"))
