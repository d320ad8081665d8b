"""Words between ASCII blanks, numbered over many texts at once, and the words that repeated runs of them cover."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np

from hearth.llm.common import ship

ship(__name__)


def numbered(texts: Iterable[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text, the number of each word (equal words have equal numbers) and how many words each text has.

    ``bytes.split`` splits at space, tab, line feed, vertical tab, form feed and carriage return only.
    """
    table: dict[bytes, int] = {}
    words = [t.split() for t in texts]
    ids = np.fromiter((table.setdefault(w, len(table)) for ws in words for w in ws), np.int64, sum(map(len, words)))
    return words, ids, np.array([len(ws) for ws in words], np.int64)


def _named(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One number for each different pair."""
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def in_repeats(ids: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """Whether a word lies in a window of ``k`` consecutive words that its text holds twice or more.

    Windows are named by joining names of shorter ones, so no two different windows share a name.  The first name holds the
    text's number: windows that cross from one text into the next cannot repeat.
    """
    n = len(ids)
    out = np.zeros(n, bool)
    if n < k:
        return out
    one = _named(np.repeat(np.arange(len(counts)), counts), ids)
    name, width = one, 1
    for bit in bin(k)[3:]:
        name = _named(name[: n - 2 * width + 1], name[width:])
        width *= 2
        if bit == "1":
            name = _named(name[: n - width], one[width:])
            width += 1
    begins = np.flatnonzero(np.bincount(name)[name] > 1)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, begins, 1)
    np.add.at(edges, begins + k, -1)
    return np.cumsum(edges)[:n] > 0
