"""Content-defined chunk borders by a gear rolling hash, in numpy.

The hash of a position is ``h = (h << 1) + G[byte]`` over the bytes up to it. In ``b`` bits it depends on the
last ``b`` bytes only, so equal passages get equal hashes after that many bytes wherever they stand.
"""

import numpy as np

from tremorlake.llm.textkit import seeds

_GEAR = seeds("gear", 256) >> np.uint64(16)


def rolling(data: np.ndarray, kind=np.uint32) -> np.ndarray:
    """The gear hash at every byte, in as many bits as ``kind`` has."""
    out = _GEAR.astype(kind)[data]
    span, bits = 1, np.dtype(kind).itemsize * 8
    while span < bits:  # the hash over 2 n bytes from two hashes over n
        longer = out.copy()
        longer[span:] += out[:-span] << kind(span)
        out, span = longer, span * 2
    return out


def cuts(data: np.ndarray, mean: int) -> np.ndarray:
    """Places to cut UTF-8 bytes into chunks of ``mean`` bytes on average, a power of two; never inside a character."""
    bits = mean.bit_length() - 1
    at = np.flatnonzero(rolling(data) >> np.uint32(32 - bits) == 0) + 1
    at = at[at < len(data)]
    return at[(data[at] & 0xC0) != 0x80]


#: Words after which a chunk ends if no border came.
LONGEST = 64


def word_cuts(data: np.ndarray, start: np.ndarray, doc: np.ndarray, reach: int) -> np.ndarray:
    """Numbers of the words that begin a chunk: the first of each text, and those at a local minimum of the hash.

    A word begins a chunk when the hash just before it is below those of the ``reach`` words before it and
    not above those of the ``reach`` words after it, within its text; a chunk ends after ``LONGEST`` words. ``start`` and ``doc`` are each word's
    first byte in ``data`` and text; equal words have equal borders if ``data`` is :func:`textkit.Words.stream`.
    """
    if not len(start):
        return np.zeros(0, dtype=np.int64)
    value = rolling(data, np.uint16)[start - 1].astype(np.int32)  # a text's first word is a border anyhow
    least = np.ones(len(start), dtype=bool)
    for k in range(1, reach + 1):
        same = doc[k:] == doc[:-k]
        least[k:] &= ~same | (value[k:] < value[:-k])
        least[:-k] &= ~same | (value[:-k] <= value[k:])
    least[1:] |= doc[1:] != doc[:-1]
    least[0] = True
    first = np.flatnonzero(least)
    size = np.diff(np.append(first, len(start)))
    for k in np.flatnonzero(size > LONGEST):  # words that repeat have no least one
        least[first[k]:first[k] + size[k]:LONGEST] = True
    return np.flatnonzero(least)
