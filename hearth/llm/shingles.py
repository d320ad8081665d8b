"""Word shingles of many texts at once, as 64-bit hashes.

Words are maximal runs of ASCII letters and digits and of any non-ASCII bytes, lower-cased first.  A shingle is ``width``
consecutive words; a text with fewer words (but one) is one shingle.
"""

from __future__ import annotations

import numpy as np

from hearth.llm.common import ship

ship(__name__)

_IN_WORD = np.zeros(256, bool)
_IN_WORD[128:] = True
for _c in b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _IN_WORD[_c] = True
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply) over an array of uint64."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    """Powers of the base, as many as the longest word so far."""
    global _powers
    if len(_powers) < n:
        grown = np.full(max(n, 64), _BASE, np.uint64)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text the number of its words."""
    raw = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    inside = _IN_WORD[data]
    step = np.diff(inside.view(np.int8), prepend=np.int8(0))
    begins, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not len(begins):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    lengths = ends - begins
    at = np.flatnonzero(inside)
    offset = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    value = _LETTER[data[at]] * _power(int(lengths.max()))[offset]
    hashes = mix(np.add.reduceat(value, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))
    stops = np.cumsum(np.array([len(r) + 1 for r in raw]))
    counts = np.diff(np.searchsorted(begins, stops), prepend=0)
    return hashes, counts


def shingle_hashes(texts: list[str | None], width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles in order, and for each text the number of its shingles."""
    words, counts = word_hashes(texts)
    n = len(words)
    made = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    if not n:
        return words, made
    rolled = np.zeros(n, np.uint64)
    padded = np.r_[words, np.zeros(width, np.uint64)]
    ends = np.cumsum(counts)
    room = np.repeat(ends, counts) - np.arange(n)  # words left in the text from here
    for k in range(width):
        rolled = rolled * np.uint64(_BASE) + np.where(room > k, padded[k : n + k], np.uint64(0))
    starts = np.cumsum(made) - made
    first = np.repeat(ends - counts, made) + np.arange(int(made.sum())) - np.repeat(starts, made)
    return mix(rolled[first] + np.uint64(width)), made
