"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text.

Folding lower-cases, maps look-alike letters of other scripts and full-width, mathematical and circled forms to Latin ones, digits
and signs used as letters to those letters, punctuation to spaces, and drops combining marks and characters that do not show.  Lexicon entries match whole words; matches inside an
exception phrase do not count.  The sum of the matched weights, divided by the length in words, goes through a logistic
curve to a score from 0 to 1.

Lexicon and curve are learned from labelled rows: at most ``SAMPLE_ROWS`` of them, the first by a hash of their id (a
bounded sample, as a documented parameter).  The lexicon holds every word of the sample that is telling enough.  A word's weight is the log odds of toxic against clean rows.  Toxic rows
count by the word that stands before its first place in the row, each different one once, so that a family of near
copies, in which it follows the same word, counts once.  Scoring reads every whole text.

Defined cases: null and empty texts hold no match and get the score of length 0; null ids are scored; repeated rows are
scored alike; without any labelled row of either kind the seed words with weight 1 and a fixed curve are used; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import math
import re
import string
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import ship, slices, tidy

ship(__name__)

SAMPLE_ROWS = 40_000
MIN_CONTEXTS, MIN_ODDS = 3, 8.0

# Look-alike letters (Cyrillic, Greek), digits and signs used as letters.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁһкмтвнαβεικνορτυχ", "aeopcyxijsdhkmtbhabeiknoptux", strict=True))
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
# Phrases in which a listed word is harmless, and words to begin with where no label is given.
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "loser bracket", "pond scum")
SEED = ("trash", "pathetic", "idiot", "disgusting", "worthless", "stupid", "clown", "loser", "scum", "moron")



def _folds() -> dict[str, str]:
    """What each character becomes, followed to the end: a full-width four becomes a four and so an ``a``."""
    signs = string.punctuation + string.whitespace + "".join(map(chr, (*range(0x2000, 0x200B), *range(0x2010, 0x2030), 0x2212, 0x00A0, 0x3000)))
    out = {c: " " for c in signs} | HOMOGLYPHS | SUBSTITUTES
    # Letters and digits in other dress: full-width, mathematical, circled and letter-like ones.
    for c in map(chr, (*range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800), *range(0x2460, 0x2500), *range(0x2100, 0x2150))):
        plain = unicodedata.normalize("NFKC", c).lower()
        if plain.isascii() and plain:
            out[c] = "".join(out.get(x, x) for x in plain)
    # Marks and joiners that do not show.
    out |= dict.fromkeys(map(chr, (*range(0x0300, 0x0370), 0x00AD, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xFEFF)), "")
    return out


_FOLD = str.maketrans(_folds())
_SHOUTS = re.compile(r"!+(?=[^\w$@]|\Z)")  # that end a word


def fold(text: str | None) -> str:
    """The folded text between two spaces; trailing ``!`` and the like of a word are its punctuation, not letters."""
    low = (text or "").lower()
    if "!" in low:
        low = _SHOUTS.sub(" ", low)
    return " " + low.translate(_FOLD) + " "


@dataclass
class Model:
    weights: dict[str, float]
    intercept: float
    slope: float
    exceptions: tuple[str, ...] = EXCEPTIONS

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for word, w in self.weights.items():
            found.add_word(f" {word} ", (len(word) + 2, w))
        for phrase in self.exceptions:
            found.add_word(fold(phrase), (len(phrase) + 2, None))
        if not len(found):
            found.add_word("\0", (1, 0.0))
        found.make_automaton()
        return found


def density(text: str | None, automaton: ahocorasick.Automaton) -> tuple[float, int]:
    """Length-normalised weight of the matches, and their number."""
    folded = fold(text)
    hits, excused = [], []
    for end, (n, w) in automaton.iter(folded):
        (excused if w is None else hits).append((end - n + 1, end, w))
    if excused:
        hits = _unexcused(hits, excused)
    if not hits:
        return 0.0, 0
    return math.log1p(100.0 * sum(h[2] for h in hits) / (len(folded.split()) + 10)), len(hits)


def _unexcused(hits: list[tuple], excused: list[tuple]) -> list[tuple]:
    """The hits that lie in no exception phrase; both lists are in the order of their ends, and are read once, from the last end to the first.

    A phrase holds a hit if it ends no earlier and begins no later: of all phrases that end no earlier, the least begin decides.
    """
    out, at, least = [], len(excused) - 1, math.inf
    for h in reversed(hits):
        while at >= 0 and excused[at][1] >= h[1]:
            least = min(least, excused[at][0])
            at -= 1
        if h[0] < least:
            out.append(h)
    return out[::-1]


def _worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of each slice of labelled texts: (word, word before it, 1) for toxic rows, (word, none, number) for clean ones."""
    for batch in batches:
        for part in slices(batch, "text", 4 << 20):
            bad, clean = set(), Counter()
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                words = fold(text).split()
                if toxic:
                    first = {}
                    for before, word in zip(["", *words], words, strict=False):
                        first.setdefault(word, before)
                    bad.update(first.items())
                else:
                    clean.update(set(words))
            rows = [(w, b, 0) for w, b in sorted(bad)] + [(w, None, n) for w, n in sorted(clean.items())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["word", "before", "n"]
            )


def _densities(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                x = [density(t, automaton)[0] for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_pydict({"bin": pa.array([round(v * 20) for v in x], pa.int32()), "toxic": part.column("toxic").cast(pa.int32())})

    return run


def _curve(bins: list[tuple[int, int, int]]) -> tuple[float, float]:
    """Intercept and slope of the logistic curve on (bin, label, count) rows, by damped Newton steps with a small ridge."""
    a, b = -2.0, 1.0
    for _ in range(50):
        g0 = g1 = 0.0
        h00 = h11 = 1e-6
        h01 = 0.0
        g1 -= 0.02 * b
        h11 += 0.02
        for x, y, n in bins:
            v = x / 20.0
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * v))))
            g0 += n * (y - p)
            g1 += n * (y - p) * v
            w = n * p * (1 - p) + 1e-9
            h00, h01, h11 = h00 + w, h01 + w * v, h11 + w * v * v
        det = h00 * h11 - h01 * h01
        da, db = (h11 * g0 - h01 * g1) / det, (h00 * g1 - h01 * g0) / det
        scale = min(1.0, 3.0 / max(abs(da), abs(db), 1e-12))
        a, b = a + scale * da, b + scale * db
        if abs(da) + abs(db) < 1e-6:
            break
    return a, b


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from ``doc_id, text`` and ``doc_id, toxic``; the caller has left out the rows not to learn from."""
    picked = (
        labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    # At most sample_rows rows of two numbers: a proven bound for the broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic")
    totals = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return Model(dict.fromkeys(SEED, 1.0), -2.0, 3.0)
    pairs = rows.mapInArrow(tidy(_worded), "word string, before string, n long")
    counted = pairs.groupBy("word").agg(
        F.count_distinct("before").alias("t"), F.sum("n").alias("n")
    )
    odds = (F.col("t") / F.lit(float(bad))) / ((F.col("n") + 0.5) / F.lit(float(good)))
    top = counted.where((F.col("t") >= MIN_CONTEXTS) & (F.length("word") > 1) & (odds >= MIN_ODDS))
    weights = {r["word"]: min(6.0, math.log(r["t"] / bad / ((r["n"] + 0.5) / good))) for r in top.collect()}
    model = Model(weights or dict.fromkeys(SEED, 1.0), -2.0, 3.0)
    binned = rows.mapInArrow(tidy(_densities(model)), "bin int, toxic int").groupBy("bin", "toxic").count()
    model.intercept, model.slope = _curve(sorted((r["bin"], r["toxic"], r["count"]) for r in binned.collect()))
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, n_hits`` of every row of ``doc_id, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                found = [density(t, automaton) for t in part.column("text").to_pylist()]
                scores = [1 / (1 + math.exp(-max(-500.0, min(500.0, model.intercept + model.slope * x)))) for x, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(scores, pa.float64()), pa.array([n for _, n in found], pa.int64())], names=["doc_id", "score", "n_hits"]
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(tidy(run), f"doc_id {kind}, score double, n_hits long")


def keep_clean(docs: DataFrame, model: Model, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below the limit, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = model.automaton()
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                x = [density(t, automaton)[0] for t in part.column("text").to_pylist()]
                yield part.filter(pa.array([1 / (1 + math.exp(-max(-500.0, min(500.0, model.intercept + model.slope * v)))) < limit for v in x], pa.bool_()))

    return docs.mapInArrow(tidy(run), docs.schema)
