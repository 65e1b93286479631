"""Token ids of texts, with a cache of words."""

from __future__ import annotations

import functools
import itertools
import os
from collections.abc import Iterable

CACHED_WORDS, CACHED_CHARS = 1_000_000, 48
#: Words, known and unknown to a vocabulary, by which an encoder sees how a mark after a letter is cut.
PROBES = ("a", "the", "word", "Word", "HIJ", "Wörter", "qzxjvk", "e", "it's", "x9y")
#: ASCII marks but the apostrophe; runs of them at the end of a word are cut off, some of them as a probe.
MARKS, TAILS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~", (".", ",", "!!", ".***", "%%%", ",$", "|>", "-")
#: So many words of ASCII letters, which tokenizers here lower-case but do not cut or change else, are encoded as one text.
PLAIN_WORDS = 64


def split(text: str) -> list[str]:
    """Words at ASCII white space that every tokenizer here drops, so that a text's ids are those of its words in turn.

    Tokenizers here lower-case, so ASCII texts are lower-cased before; not if they may hold the name of a special token.
    """
    if text.isascii() and "<|" not in text:
        text = text.lower()
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def _is_plain(word: str) -> bool:
    return word.isascii() and word.isalpha()


class Encoder:
    """Ids of whole texts as bytes, little-endian unsigned 32-bit.

    For tokenizers that cut at white space and drop it, and lower-case. Words are encoded once and kept, until
    CACHED_WORDS are and the cache starts anew.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.words: dict[str, bytes] = {}
        #: Ids of marks that a tokenizer cuts off after a letter, so that words are encoded once with and without them.
        self.marks: dict[str, bytes] | None = dict(zip(TAILS, self._encode(TAILS), strict=True))
        if any(self._encode([w + m])[0] != self._encode([w])[0] + ids for m, ids in self.marks.items() for w in PROBES):
            self.marks = None
        self.bare = self._bare()

    def _bare(self):
        """The tokenizer's model alone, if its words end in tokens of their own; `ends` has these."""
        import numpy as np
        from tokenizers import Tokenizer, pre_tokenizers

        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if not suffix:
            return None
        bare = Tokenizer(self.tokenizer.model)
        bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        self.ends[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        probes = [w for w in PROBES if _is_plain(w)]
        return bare if self._plain(bare, probes) == self._encode(probes) else None

    def _plain(self, bare, words: list[str]) -> list[bytes] | None:
        """As `_encode`, for plain words: many as one text, cut after the tokens that end words. None if that fails."""
        import numpy as np

        lines = [" ".join(words[i : i + PLAIN_WORDS]).lower() for i in range(0, len(words), PLAIN_WORDS)]
        out = bare.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.fromiter(itertools.chain.from_iterable(e.ids for e in out), "<u4")
        ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        data = ids.tobytes()
        if len(ends) != len(words) or (ends and ends[-1] != len(data)):
            return None
        return [data[a:b] for a, b in itertools.pairwise([0, *ends])]

    def _encode(self, words: Iterable[str]) -> list[bytes]:
        import numpy as np

        out = self.tokenizer.encode_batch_fast(list(words), add_special_tokens=False)
        ids = [e.ids for e in out]
        data = np.fromiter(itertools.chain.from_iterable(ids), "<u4").tobytes()
        ends = list(itertools.accumulate((4 * len(x) for x in ids), initial=0))
        return [data[a:b] for a, b in itertools.pairwise(ends)]

    def _ids(self, words: list[str]) -> Iterable[tuple[str, bytes]]:
        """Each word with its ids."""
        plain = [w for w in words if _is_plain(w)] if self.bare else []
        found = self._plain(self.bare, plain) if plain else []
        if found is None:
            plain, found = [], []
        rest = list(set(words).difference(plain)) if plain else words
        return itertools.chain(zip(plain, found, strict=True), zip(rest, self._encode(rest), strict=True))

    def _cut(self, words: Iterable[str]) -> dict[str, str]:
        """Words that end in marks after a letter, without these."""
        if self.marks is None:
            return {}
        out = {}
        for word in words:
            stem = word.rstrip(MARKS)
            if len(stem) < len(word) and stem[-1:].isascii() and stem[-1:].isalpha() and "<|" not in word:
                out[word] = stem
        return out

    def texts(self, texts: Iterable[str], end: int) -> list[bytes]:
        """For each text its ids and then `end`."""
        tail, known = int(end).to_bytes(4, "little"), self.words
        words_of = [split(text) for text in texts]
        if len(known) > CACHED_WORDS:
            known.clear()
            if self.marks:
                self.marks.clear()
        fresh = set().union(*words_of).difference(known)
        marked = self._cut(fresh)
        new = list(fresh.difference(marked).union(set(marked.values()).difference(known)))
        if marked:
            tails = list({w[len(stem) :] for w, stem in marked.items()}.difference(self.marks))
            self.marks.update(zip(tails, self._encode(tails), strict=True))
        long = {}
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            for word, ids in self._ids(part):
                (known if len(word) <= CACHED_CHARS else long)[word] = ids
        for word, stem in marked.items():
            ids = (long[stem] if stem in long else known[stem]) + self.marks[word[len(stem) :]]
            (known if len(word) <= CACHED_CHARS else long)[word] = ids
        if long:
            return [b"".join([*(known[w] if w in known else long[w] for w in words), tail]) for words in words_of]
        get = known.__getitem__
        return [b"".join(map(get, words)) + tail for words in words_of]


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder for each process, so that its cache lives as long as the worker."""
    return Encoder(path)
