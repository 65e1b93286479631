"""Text to feature values, one row at a time; nothing shuffles."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from string import ascii_letters, ascii_uppercase, digits

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

try:
    from _md5 import md5  # short texts take it half the time of the one in hashlib
except ImportError:
    from hashlib import md5

BLANK = r"[ \t\n\r\f]+"
INK = r"[^ \t\n\r\f]"
TOKEN, RAW_TOKEN = re.compile(rf"{INK}+"), re.compile(rf"{INK}+".encode())
# What str.split takes for white space and TOKEN does not.
OTHER_BLANK = re.compile("[\x0b\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
REMEMBERED = 1 << 18  # grams whose slot a Python worker keeps

# The key dictionary, in order; key i is feature `keys_i`.
KEY_PATTERNS: tuple[str, ...] = (
    r"[0-9]",
    r"[0-9]{4}",
    r"[A-Z]{2}",
    r"https?://",
    r"www\.",
    r"[A-Za-z0-9._]@[A-Za-z0-9]",
    r"<[a-z]",
    r"[{}]",
    r"[;]",
    r"[?]",
    r"[!]",
    r"[!][!]",
    r"[%]",
    r"[$€£]",
    r"[*][*]",
    r"[#]",
    r"[()]",
    r"[\"']",
    r"[:]",
    r"\n\n",
    r"[.][.][.]",
    r"[àâçéèêëîïôûù]",
    r"[äöüß]",
    r"[áíñóú¿¡]",
    r"[Ll]icense",
    r"[Cc]opyright",
    r"(^|[ \n])[Tt]he([ \n.,]|$)",
    r"(^|[ \n])[Uu]nd([ \n.,]|$)",
    r"(^|[ \n])[Ll]e([ \n.,]|$)",
    r"(^|[ \n])[Ll]os([ \n.,]|$)",
    r"idiot",
    r"stupid",
    r"trash",
    r"loser",
    r"moron",
    r"clown",
    r"scum",
    r"worthless",
    r"pathetic",
    r"disgusting",
)

DESCRIPTOR_NAMES: tuple[str, ...] = (
    "n_chars",
    "n_tokens",
    "n_lines",
    "mean_token_len",
    "max_token_len",
    "distinct_token_ratio",
    "distinct_line_ratio",
    "letter_ratio",
    "upper_ratio",
    "digit_ratio",
    "punct_ratio",
    "blank_ratio",
    "other_ratio",
    "token_entropy",
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def has_token(text: Column) -> Column:
    return text.rlike(INK)


def _by_row(text: Column, kind: str, value: Callable[[bytes], object]) -> Column:
    """`value` of each text's bytes, in Arrow batches; null stays null."""

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else value(bytes(t)) for t in texts], index=texts.index, dtype=object)

    return run(text.cast("binary"))


def _text(raw: bytes) -> str:
    """Bytes that are no UTF-8 pass unchanged."""
    return raw.decode("utf-8", "surrogateescape")


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogateescape")


def _slots(grams: Iterable[bytes], size: int) -> np.ndarray:
    """Sorted distinct slots, each as `hashing.hash_slot` gives it."""
    first = np.frombuffer(b"".join([md5(g).digest() for g in grams]), ">u8")[::2]
    return np.unique((first >> np.uint64(4)) % np.uint64(size)).astype(np.int32)


class _Slots(dict):
    """Slots of coded grams seen before, forgotten when there are too many."""

    def __init__(self, slot: Callable[[int], int]):
        super().__init__()
        self.slot = slot

    def __missing__(self, gram: int) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[gram] = found = self.slot(gram)
        return found


def ngram_bits(text: Column, sizes: Sequence[int] = (1, 2, 3), bits: int = 1024) -> Column:
    """Set bits of hashed token n-grams; null when the text has no token. Equal grams are hashed once."""

    def value(raw: bytes) -> np.ndarray | None:
        parts = RAW_TOKEN.findall(raw)
        grams = set()
        for n in sizes:
            grams.update(map(b" ".join, zip(*(parts[i:] for i in range(n)))))
        return _slots(grams, bits) if parts else None

    return _by_row(text, "array<int>", value)


def chargram_bits(text: Column, n: int = 4, bits: int = 1024) -> Column:
    """Set bits of hashed character n-grams; null when the text has no token.

    Where a gram's characters fit in 64 bits, the distinct ones of a text are found as numbers.
    """
    width = 64 // n
    mask = (1 << width) - 1

    def decoded(code: int) -> bytes:
        return _bytes("".join(chr(code >> width * i & mask) for i in reversed(range(n))))

    known = _Slots(lambda code: int(_slots([decoded(code)], bits)[0]))

    def value(raw: bytes) -> np.ndarray | None:
        if not RAW_TOKEN.search(raw):
            return None
        text = _text(raw)
        last = len(text) - n + 1
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        if last < 1 or codes.max() > mask:
            return _slots({_bytes(text[i : i + n]) for i in range(last)}, bits)
        grams = codes[:last]
        for i in range(1, n):
            grams = grams << np.uint64(width) | codes[i : last + i]
        found = map(known.__getitem__, np.unique(grams).tolist())
        return np.unique(np.fromiter(found, np.int32))

    return _by_row(text, "array<int>", value)


ATOM = re.compile(
    r"(\[[^\]\[\\^&][^\]\[\\&]*\]|\((?!\?)(?:\[(?:[^\]\[\\&]|\\.)*\]|[^()\[\]\\])*\)|\\.|.)([?*+]|\{[0-9,]*\})?", re.DOTALL
)
ESCAPED = {r"\n": "\n", r"\t": "\t"}


def _choices(atom: str) -> str:
    """The characters that one part of a pattern stands for; none if they are not few and plain."""
    if atom in ESCAPED:
        return ESCAPED[atom]
    if len(atom) == 2 and atom[0] == "\\" and not atom[1].isalnum():
        return atom[1]
    if atom[0] == "[" and len(atom) > 2 and "-" not in atom:
        return atom[1:-1] if len(atom) <= 6 else ""
    return atom if len(atom) == 1 and atom not in "\\.^$|()[]{}*+?" else ""


def needed(pattern: str, most: int = 4) -> tuple[list[str], bool]:
    """(texts one of which lies in all that matches `pattern`, whether they are all that it says); no texts if not known."""
    atoms = [m.groups() for m in ATOM.finditer(pattern)]
    runs, whole = [[""]], True
    for atom, quantifier in atoms:
        if atom in ("|", "(", ")", "[", "]", "{", "}") or (atom[0] == "\\" and atom[1:].isalnum() and atom not in ESCAPED):
            return [], False  # the expression says more than a row of parts
        choices = "" if quantifier else _choices(atom)
        grown = [r + c for r in runs[-1] for c in choices]
        if choices and len(grown) <= most:
            runs[-1] = grown
        else:
            whole = False
            runs.append([""])
    best = max(runs, key=lambda run: len(run[0]))
    return (best, whole) if best[0] else ([], False)


# What `plain` reads: escaped marks, classes of characters and ranges, groups, repeats and ends.
PLAIN = re.compile(
    r"(?:\\[nt.*+?$()\[\]{}/\-]|\[(?:\\[nt\"'.,]|[^\]\[\\^&\-])(?:\\[nt\"'.,]|[^\]\[\\&\-]|(?<=[A-Za-z0-9])-(?=[A-Za-z0-9]))*\]|[^\\.\[\]{}()*+?|^$]"
    r"|[()|^$]|(?<=[^(|^$*+?{}])[*+?](?![*+?{])|(?<=[^(|^$*+?{}])\{[0-9]+\}(?![*+?{]))+"
)
#: What `$` stands for in a Java expression.
JAVA_END = r"(?=(?:\r\n|(?<!\r)\n|[\r\x85\u2028\u2029])?\Z)"


def plain(pattern: str) -> re.Pattern | None:
    """`pattern`, as Java reads it, for Python; none where the two might differ."""
    if not PLAIN.fullmatch(pattern) or "(?" in pattern:
        return None
    kept = re.split(r"(\\.|\[[^\]]*\])", pattern)
    return re.compile("".join(p if i % 2 else p.replace("$", JAVA_END) for i, p in enumerate(kept)))


def _finder(pattern: str) -> Callable[[str, frozenset], bool] | None:
    """Whether a text, given with the set of its characters, has a match; none where Python might differ from Java.

    Texts that a match must hold are looked for first; a pattern that says more runs as regex where one is found.
    """
    found = plain(pattern)
    if found is None:
        return None
    if re.fullmatch(r"\[[^\]]+\]", pattern):
        marks = re.sub(r"\\(.)", lambda m: ESCAPED.get(m[0], m[1]), pattern[1:-1])
        ranges = re.findall(r"([A-Za-z0-9])-([A-Za-z0-9])|(.)", marks, re.DOTALL)
        among = frozenset(chr(c) for a, b, x in ranges for c in range(ord(x or a), ord(x or b) + 1))
        return lambda text, chars: not among.isdisjoint(chars)
    texts, whole = needed(pattern)
    if whole and len(texts) == 1:
        return lambda text, chars, t=texts[0]: t in text
    if whole:
        return lambda text, chars: any(t in text for t in texts)
    if texts:
        return lambda text, chars: any(t in text for t in texts) and found.search(text) is not None
    return lambda text, chars: found.search(text) is not None


def key_bits(text: Column, patterns: Sequence[str] = KEY_PATTERNS) -> Column:
    """Positions of the matching patterns, from 0; null when the text has no token.

    Patterns that Python reads as Java does are searched in Arrow batches, all in one pass over a text; if there are
    others, all run as expressions of Spark.
    """
    finders = [_finder(p) for p in patterns]
    if None in finders:
        return _key_bits(text, patterns)

    def value(raw: bytes) -> np.ndarray | None:
        if not RAW_TOKEN.search(raw):
            return None
        found = _text(raw)
        chars = frozenset(found)
        return np.array([i for i, has in enumerate(finders) if has(found, chars)], np.int32)

    return _by_row(text, "array<int>", value)


def _key_bits(text: Column, patterns: Sequence[str]) -> Column:
    """Texts that a match must hold are searched bytewise; a pattern that says more runs as regex where one is found."""

    def found(pattern: str) -> Column:
        texts, whole = needed(pattern)
        if not texts:
            return text.rlike(pattern)
        some = reduce(lambda a, b: a | b, [text.contains(F.lit(t)) for t in texts])
        return some if whole else some & text.rlike(pattern)

    hits = F.array(*[F.when(found(p), F.lit(i)) for i, p in enumerate(patterns)])
    return F.when(has_token(text), F.array_compact(hits))


def _share(count: int, total: int) -> float:
    return count / total if total else 0.0


def _among(text: bytes, chars: str) -> int:
    """How many bytes of `text` are among the ASCII characters `chars`."""
    return len(text) - len(text.translate(None, chars.encode()))


INK_CHARS = "".join(map(chr, range(33, 127)))


def _entropy(counts: Counter) -> float:
    """Shannon entropy in bits of counted items, in the order of the items."""
    n, total, log2 = counts.total(), 0.0, math.log(2)
    part = {c: c / n * (math.log(c / n) / log2) for c in set(counts.values())}
    for item in sorted(counts):
        total -= part[counts[item]]
    return total


def descriptors(text: Column) -> Column:
    """Array of the values named in DESCRIPTOR_NAMES; null when the text has no token."""

    def value(raw: bytes) -> list[float] | None:
        text = _text(raw)
        counts = Counter(TOKEN.findall(text) if OTHER_BLANK.search(text) else text.split())
        if not counts:
            return None
        n_chars, n_tokens, lines = len(text), counts.total(), text.split("\n")
        kinds = (ascii_letters, ascii_uppercase, digits, INK_CHARS, " \t\n\r\f")
        letters, upper, numbers, ink, blank = (_among(raw, kind) for kind in kinds)
        punct = ink - letters - numbers
        values = (
            n_chars,
            n_tokens,
            len(lines),
            _share(n_chars - blank, n_tokens),
            max(map(len, counts)),
            _share(len(counts), n_tokens),
            _share(len(set(lines)), len(lines)),
            _share(letters, n_chars),
            _share(upper, n_chars),
            _share(numbers, n_chars),
            _share(punct, n_chars),
            _share(blank, n_chars),
            _share(n_chars - letters - numbers - punct - blank, n_chars),
            _entropy(counts),
        )
        return [float(v) for v in values]

    return _by_row(text, "array<double>", value)
