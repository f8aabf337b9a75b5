"""Word and hash helpers in numpy for the operators that run Python inside tasks.

A word is a run of ASCII letters and digits and bytes of non-ASCII characters; A-Z count as a-z.
"""

from collections.abc import Iterable, Iterator

import numpy as np

#: Bytes of text handled at once; a longer text is handled alone and whole.
SLICE = 1 << 20

_SAME = np.arange(256, dtype=np.uint8)
_LOWER = _SAME.copy()
_LOWER[65:91] += 32
#: 1 for bytes of words; in the second table also 2 for signs, which make tokens of their own.
_WORDS = np.zeros(256, dtype=np.uint8)
_WORDS[48:58] = _WORDS[97:123] = _WORDS[65:91] = _WORDS[128:] = 1
_TOKENS = _WORDS.copy()
_TOKENS[33:127][_TOKENS[33:127] == 0] = 2

#: Stands before and after each text, so a rolling hash over 16 bytes never sees its neighbour.
_BETWEEN = b"\n" * 16

# Odd numbers, so powers have inverses modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS = np.ones(1, dtype=np.uint64)
_INVERSES = np.ones(1, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeds(name: str, n: int) -> np.ndarray:
    """``n`` odd 64-bit numbers that depend on ``name`` alone."""
    start = np.frombuffer(name.encode().ljust(8, b".")[:8], dtype=np.uint64)[0]
    return mix(start + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        size = max(n, SLICE + 4096)
        for name, base in (("_POWERS", _BASE), ("_INVERSES", _INVERSE)):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            globals()[name] = np.cumprod(row, dtype=np.uint64)
    return _POWERS, _INVERSES


def slices(texts: Iterable[bytes], limit: int = SLICE) -> Iterator[list[bytes]]:
    """Whole texts in order, in lists of about ``limit`` bytes."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text) + 1
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


class Words:
    """The words of some texts: of word ``i`` the text ``doc[i]``, the bytes ``start[i]:end[i]`` and a 64-bit hash.

    With ``signs``, runs of other printable characters are words too, and case counts.
    """

    def __init__(self, texts: list[bytes], signs: bool = False):
        self.n_texts = len(texts)
        self.bytes = np.frombuffer(_BETWEEN.join([b"", *texts, b""]), dtype=np.uint8)
        self.text_bytes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.text_start = len(_BETWEEN) + np.concatenate([[0], np.cumsum(self.text_bytes + len(_BETWEEN))])
        kind = (_TOKENS if signs else _WORDS)[self.bytes]
        edges = np.flatnonzero(np.diff(kind, prepend=np.uint8(0)))  # the last is no word's start: a line break ends all
        begins = np.flatnonzero(kind[edges])
        self.start, self.end = edges[begins], edges[begins + 1] if len(begins) else edges[begins]
        self.doc = np.searchsorted(self.text_start, self.start, side="right") - 1
        powers, inverses = _powers(len(self.bytes))
        sums = np.zeros(len(self.bytes) + 1, dtype=np.uint64)
        np.cumsum(((_SAME if signs else _LOWER)[self.bytes].astype(np.uint64) + np.uint64(1)) * powers[:len(self.bytes)], out=sums[1:])
        self.hash = mix((sums[self.end] - sums[self.start]) * inverses[self.start])
        #: words[first[d]:first[d + 1]] belong to text d
        self.first = np.searchsorted(self.doc, np.arange(self.n_texts + 1))

    def stream(self) -> tuple[np.ndarray, np.ndarray]:
        """The words alone, in small letters, a space after each and ``_BETWEEN`` before each text; and where each word begins."""
        size = self.end - self.start
        total = np.cumsum(size + 1)
        begin = total - size - 1 + len(_BETWEEN) * (self.doc + 1)
        out = np.full((int(total[-1]) if len(total) else 0) + len(_BETWEEN) * (self.n_texts + 1), ord(" "), dtype=np.uint8)
        inside = np.zeros(len(self.bytes) + 1, dtype=np.int8)
        inside[self.start], inside[self.end] = 1, -1
        at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int8))
        out[at + np.repeat(begin - self.start, size)] = _LOWER[self.bytes[at]]
        return out, begin

    def ngrams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash and text of every run of ``n`` words; a text with fewer words, but not none, has one run of all."""
        counts = np.diff(self.first)
        if not len(self.hash):
            return self.hash, self.doc
        short = np.flatnonzero((counts > 0) & (counts < n))
        size = max(0, len(self.hash) - n + 1)
        total = np.zeros(size, dtype=np.uint64)
        factor = seeds("ngram", n)
        for k in range(n):
            total += mix(self.hash[k:k + size] + factor[k]) * factor[n - 1 - k]
        whole = self.doc[:len(total)] == self.doc[n - 1:] if len(total) else np.zeros(0, dtype=bool)
        hashes, docs = total[whole], self.doc[:len(total)][whole]
        if len(short):
            extra = np.zeros(len(short), dtype=np.uint64)
            for i, d in enumerate(short):
                own = self.hash[self.first[d]:self.first[d + 1]]
                extra[i] = (mix(own + factor[:len(own)]) * factor[::-1][:len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
            hashes, docs = np.concatenate([hashes, extra]), np.concatenate([docs, short])
            order = np.argsort(docs, kind="stable")
            hashes, docs = hashes[order], docs[order]
        return mix(hashes), docs


def as_bytes(column) -> list[bytes]:
    """A pandas column of texts as UTF-8; null is empty."""
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in column]
