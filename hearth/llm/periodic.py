"""Periodic runs of words: repeated k-gram masking, then the Main-Lorentz search in what survives.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are identical) of at least
``max(LEAST, POWER * q)`` words that no neighbouring word extends keeping the period.  A word is dropped if a run contains it
after that run's first ``q`` words.

*Masking.*  A run overlaps itself, shifted by its period, in at least ``k`` words, the least of ``max(LEAST, POWER * q) - q`` over all
``q`` (5 words at the defaults).  Its windows of ``k`` words therefore repeat in the document, and cover it.  Words that
no such window covers cannot join a run; the stretches between them are the segments.

*Search.*  A segment is halved again and again.  A run that crosses the middle has two periods or more on one side of it (as it
has four at least), so its period is that of a square that begins or ends at the middle: Z arrays of either half name these
periods, and each is extended to both sides.  Periods that an earlier one already explains (its multiples inside the run it gave) are
passed over, which leaves a logarithmic number a middle.  Runs that go on beyond their part belong to a larger one and are left to it.

Documents are worked on row by row in slices of bounded bytes; nothing is shuffled.

Defined cases: a null text has no words; a null ``doc_id`` is never looped; equal rows give equal results; an empty table gives an
empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import ship, slices, tidy
from hearth.llm.grams import in_repeats, numbered

ship(__name__)

LEAST, POWER = 6, 4


def overlap(least: int = LEAST, power: int = POWER) -> int:
    """The number of words that every run shares with itself a period further."""
    return min(max(least, power * q) - q for q in range(1, least + 1))


def _z(s: list[int], limit: int) -> list[int]:
    """Common prefix of ``s`` and ``s[i:]`` for ``i`` up to ``limit``."""
    n = len(s)
    z = [0] * (limit + 1)
    left = right = 0
    for i in range(1, limit + 1):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def _beside(part: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """(period, length it lasts from the beginning) of the squares that ``part`` begins with, without explained multiples."""
    limit = min(limit, len(part) // 2)
    explained = 0
    for p, common in enumerate(_z(part, limit)):
        if p and common >= p and 2 * p > explained:
            explained = p + common
            yield p, explained


def runs(w: list[int], least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """(begin, end, period) of all runs of the sequence, by begin, then period."""
    found: dict[tuple[int, int], int] = {}
    parts = [(0, len(w))]
    while parts:
        lo, hi = parts.pop()
        if hi - lo < least:
            continue
        mid = (lo + hi) // 2
        parts += [(lo, mid), (mid, hi)]
        most = (hi - lo) // power
        crossing = []
        for p, length in _beside(w[mid:hi], most):
            begin = mid
            while begin > lo and w[begin - 1] == w[begin - 1 + p]:
                begin -= 1
            crossing.append((begin, mid + length, p))
        for p, length in _beside(w[lo:mid][::-1], most):
            end = mid
            while end < hi and w[end] == w[end - p]:
                end += 1
            crossing.append((mid - length, end, p))
        for b, e, p in crossing:
            whole = e - b >= max(least, power * p) and (b == 0 or w[b - 1] != w[b - 1 + p]) and (e == len(w) or w[e] != w[e - p])
            if whole:
                found[b, e] = min(p, found.get((b, e), p))
    return sorted(((b, e, p) for (b, e), p in found.items()), key=lambda r: (r[0], r[2]))


def segments(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, mask, False].view(np.int8)))
    yield from zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)


def loop_words(n: int, h: int) -> np.ndarray | None:
    """Which original word stands at each place of a looped document, or None where ``h`` asks for none."""
    if h is None or h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def _found(least: int, power: int):
    k = overlap(least, power)

    def described(words: list[bytes], ids: np.ndarray, mask: np.ndarray) -> tuple:
        spans = [(b + x, b + y, p) for b, e in segments(mask) if e - b >= least for x, y, p in runs(ids[b:e].tolist(), least, power)]
        digest = hashlib.sha256("".join(f"{b},{e - b},{p}\n" for b, e, p in spans).encode()).hexdigest()
        gone = np.zeros(len(words) + 1, np.int64)
        for b, e, p in spans:
            gone[b + p] += 1
            gone[e] -= 1
        kept = [x for x, d in zip(words, np.cumsum(gone).tolist(), strict=False) if not d] if spans else words
        collapsed = hashlib.sha256(b" ".join(kept)).hexdigest()
        best = min(spans, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
        top = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        return len(spans), *top, digest, collapsed, len(words), len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                words, ids, counts = numbered([t or b"" for t in part.column("text").to_pylist()])
                ends = np.cumsum(counts)
                for i, h in enumerate(part.column("h").to_pylist()):
                    at = loop_words(len(words[i]), h)
                    if at is not None:
                        words[i] = [words[i][j] for j in at.tolist()]
                        ids[ends[i] - counts[i] : ends[i]] = ids[ends[i] - counts[i] : ends[i]][at]
                mask = in_repeats(ids, counts, k)
                rows = [described(ws, ids[e - len(ws) : e], mask[e - len(ws) : e]) for ws, e in zip(words, ends, strict=True)]
                kinds = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array([r[j] for r in rows], t) for j, t in enumerate(kinds))], names=["doc_id", *RESULT])

    return run


RESULT = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words", "n_kept")


def find(docs: DataFrame, looped: bool = False, least: int = LEAST, power: int = POWER) -> DataFrame:
    """The runs of every row of ``doc_id, text``: their number, the strongest one, digests of all and of the words left.

    ``looped`` first makes documents periodic whose id asks for it (see ``loop_words``), as a known share of positive cases.
    """
    h = F.crc32(F.col("doc_id").cast("string")) if looped else F.lit(None).cast("long")
    kind = dict(docs.dtypes)["doc_id"]
    names = ", ".join(f"{c} {'string' if c.endswith('sha256') else 'long'}" for c in RESULT)
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"), h.alias("h")).mapInArrow(tidy(_found(least, power)), f"doc_id {kind}, {names}")
