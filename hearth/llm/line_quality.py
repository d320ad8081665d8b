"""Quality rules: base counts of a text, and its lines labelled content or boilerplate by a linear-chain conditional random field.

*Base.*  Words are maximal runs of anything but the six ASCII blanks.  A document fails the base rules if it has fewer than
``LEAST_WORDS`` words, or if more than a fifth of them lie in 5-word windows that the text holds twice or more.

*Field.*  The lines that hold a word form a chain.  A line speaks through levels of ten measures (length, shares of signs, capitals,
stress marks, digits, different words, repeated windows, word length, closing mark, equal earlier line), neighbouring
lines through a weight for each pair of labels.  Viterbi decoding gives the likeliest labels; a document is kept if lines of content
hold at least ``SHARE`` of the bytes of its words.

*Training.*  Maximum likelihood with a small ridge: forward and backward sums give the gradient, steps follow its signs.  The
rows are at most ``SAMPLE_ROWS`` labelled documents of at most ``SAMPLE_LINES`` lines, the first by a hash of their id (a bounded
sample, as documented parameters); executors measure the lines, the driver gets their levels.  As labels are of documents, the weights are
learned twice: first each line by itself with its document's label, which tells what lines of either kind look like; then the chains,
with the lines of a bad document that look like content as content, and those of a good one that clearly look like boilerplate
(odds above ``CLEAR``) as boilerplate, so that labels change within documents.  Judging reads every whole text.

Defined cases: a null text has no words and fails the base rules; null ids are judged; equal rows are judged alike; without
labelled rows of both kinds every line counts as content; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import ship, slices, tidy
from hearth.llm.grams import in_repeats, numbered

ship(__name__)

WINDOW, LEAST_WORDS, SHARE = 5, 10, 0.5
SAMPLE_ROWS, SAMPLE_LINES = 2_000, 2_000
CLEAR = 20.0
# Upper bounds of the levels of each measure; a value at a bound belongs to the next level.
LEVELS = {
    "words": (2, 4, 8, 16), "signs": (1e-9, 0.02, 0.1), "capitals": (0.1, 0.3, 0.6), "stress": (1e-9, 0.02, 0.1), "digits": (1e-9, 0.1, 0.3), "different": (0.4, 0.7, 0.9),
    "repeated": (1e-9, 0.2, 0.6), "word_length": (3, 5, 8), "closed": (0.5,), "again": (0.5,),
}
_OFFSETS = np.cumsum([0, *(len(b) + 1 for b in LEVELS.values())])


def _class(members: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(members)] = 1
    return out


_BLANK, _SIGN, _STRESS, _DIGIT, _CLOSING = _class(b" \t\n\x0b\x0c\r"), _class(b"#*$%&|<>"), _class(b"!?"), _class(b"0123456789"), _class(b".!?:;\"')")
_UPPER, _LOWER = _class(bytes(range(65, 91))), _class(bytes(range(97, 123)))
_FIRST = np.r_[np.ones(128, np.int64), np.zeros(64, np.int64), np.ones(64, np.int64)]  # bytes that begin a code point


@dataclass
class Measured:
    """What a slice of texts holds: base counts by text, and of every line with a word its text, bytes and levels."""

    base: dict[str, np.ndarray]
    text: np.ndarray
    size: np.ndarray
    levels: np.ndarray


def measure(texts: list[bytes]) -> Measured:
    words, ids, counts = numbered(texts)
    if not texts:
        none = np.zeros(0, np.int64)
        return Measured(dict.fromkeys(("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), none), none, none, np.zeros((0, len(LEVELS)), np.int64))
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    doc_begin = np.cumsum(sizes) - sizes
    line_begin = np.r_[0, np.flatnonzero(data[:-1] == 10) + 1]
    line_end = np.r_[line_begin[1:], len(data)] - 1
    per_line = lambda of: np.add.reduceat(of[data], line_begin)
    per_doc = lambda of: np.add.reduceat(of[data], doc_begin)
    inside = _BLANK[data] == 0
    starts = np.flatnonzero(inside & ~np.r_[False, inside[:-1]])
    word_line = np.searchsorted(line_begin, starts, side="right") - 1
    n_words = np.bincount(word_line, minlength=len(line_begin))
    again = np.zeros(len(line_begin), np.int64)
    held = np.flatnonzero(n_words)
    line_doc = np.searchsorted(doc_begin, line_begin, side="right") - 1
    seen: set[bytes] = set()
    last = -1
    raw = data.tobytes()
    for i, d, b, e in zip(held.tolist(), line_doc[held].tolist(), line_begin[held].tolist(), line_end[held].tolist(), strict=True):
        if d != last:
            seen, last = set(), d
        line = raw[b:e]
        if line in seen:
            again[i] = 1
        seen.add(line)
    repeated = in_repeats(ids, counts, WINDOW)
    by_doc = lambda flags, of: np.bincount(of, weights=flags, minlength=len(texts)).astype(np.int64)
    base = {
        "n_words": counts,
        "word_chars": per_doc(_FIRST * (1 - _BLANK)),
        "n_symbols": per_doc(_SIGN),
        "n_dup_lines": by_doc(again, line_doc),
        "n_repeat_words": by_doc(repeated, np.repeat(np.arange(len(texts)), counts)),
    }
    size = per_line(1 - _BLANK)
    share = lambda x, y: x / np.maximum(y, 1)
    upper, lower = per_line(_UPPER), per_line(_LOWER)
    vocabulary = int(ids.max(initial=0)) + 1
    different = np.bincount(np.unique(word_line * vocabulary + ids) // vocabulary, minlength=len(line_begin))
    # The last byte of a line's last word.
    stops = np.flatnonzero(inside & ~np.r_[inside[1:], False])
    closing = np.zeros(len(line_begin), np.int64)
    closing[word_line] = _CLOSING[data[stops]]  # of several words in a line the last one written stays
    values = {
        "words": n_words, "signs": share(per_line(_SIGN), size), "capitals": share(upper, upper + lower), "stress": share(per_line(_STRESS), size), "digits": share(per_line(_DIGIT), size),
        "different": share(different, n_words), "repeated": share(np.bincount(word_line, weights=repeated, minlength=len(line_begin)), n_words), "word_length": share(size, n_words),
        "closed": closing, "again": again,
    }
    levels = np.stack([np.searchsorted(np.array(LEVELS[m]), values[m][held], side="right") for m in LEVELS], axis=1)
    return Measured(base, line_doc[held], size[held], levels)


@dataclass
class Model:
    """Weights of the label boilerplate by measure and level, and of each pair of neighbouring labels (0 content, 1 boilerplate)."""

    lines: np.ndarray = field(default_factory=lambda: np.zeros(int(_OFFSETS[-1])))
    bias: float = 0.0
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def scores(self, levels: np.ndarray) -> np.ndarray:
        return self.bias + self.lines[levels + _OFFSETS[:-1]].sum(axis=1)


def decoded(scores: list[float], pairs: np.ndarray) -> list[int]:
    """The likeliest labels of a chain (Viterbi); content where both are equal."""
    (cc, cb), (bc, bb) = pairs.tolist()
    content = bad = 0.0
    back = []
    for i, s in enumerate(scores):
        if i:
            from_bad = (bad + bc > content + cc, bad + bb > content + cb)
            content, bad = (bad + bc if from_bad[0] else content + cc), (bad + bb if from_bad[1] else content + cb) + s
            back.append(from_bad)
        else:
            bad = s
    label = int(bad > content)
    out = [label]
    for from_bad in reversed(back):
        label = int(from_bad[label])
        out.append(label)
    return out[::-1] if scores else []


def gradient(model: Model, chains: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Observed less expected counts of every weight, over chains of levels (longest first) and the labels of all lines, chain by chain."""
    lengths = np.array([len(c) for c in chains])
    begins = np.cumsum(lengths) - lengths
    levels = np.concatenate(chains) + _OFFSETS[:-1]
    emit = np.zeros((len(levels), 2))
    emit[:, 1] = model.bias + model.lines[levels].sum(axis=1)
    open_ = [int((lengths > t).sum()) for t in range(int(lengths[0]))]  # chains that reach a place
    forward, backward = np.zeros_like(emit), np.zeros_like(emit)
    forward[begins] = emit[begins]
    for t in range(1, len(open_)):
        now = begins[: open_[t]] + t
        forward[now] = emit[now] + np.logaddexp(forward[now - 1, :1] + model.pairs[0], forward[now - 1, 1:] + model.pairs[1])
    pairs = np.zeros((2, 2))
    total = np.logaddexp(*forward[begins + lengths - 1].T)
    for t in range(len(open_) - 1, 0, -1):
        now = begins[: open_[t]] + t
        ahead = emit[now] + backward[now]
        joint = forward[now - 1][:, :, None] + model.pairs + ahead[:, None, :]
        pairs -= np.exp(joint - total[: open_[t], None, None]).sum(axis=0)
        backward[now - 1] = np.logaddexp(ahead[:, :1] + model.pairs[:, 0], ahead[:, 1:] + model.pairs[:, 1])
    chance = np.exp(forward[:, 1] + backward[:, 1] - np.repeat(total, lengths))
    wrong = labels - chance
    inner = np.ones(len(labels), bool)
    inner[begins] = False
    at = np.flatnonzero(inner)
    np.add.at(pairs, (labels[at - 1], labels[at]), 1)
    return np.bincount(levels.reshape(-1), weights=np.repeat(wrong, levels.shape[1]), minlength=len(model.lines)), float(wrong.sum()), pairs


def climbed(chains: list[np.ndarray], labels: np.ndarray, rounds: int = 80, ridge: float = 0.1) -> Model:
    """The weights of highest likelihood: each follows the sign of its gradient, by steps that grow while the sign stays."""
    n = int(_OFFSETS[-1])
    weights, step, before = np.zeros(n + 5), np.full(n + 5, 0.1), np.zeros(n + 5)
    for _ in range(rounds):
        model = Model(weights[:n], float(weights[n]), weights[n + 1 :].reshape(2, 2))
        lines, bias, pairs = gradient(model, chains, labels)
        g = np.r_[lines, bias, pairs.reshape(-1)] - ridge * weights
        turn = np.sign(g * before)
        step = np.clip(step * np.where(turn > 0, 1.2, np.where(turn < 0, 0.5, 1.0)), 1e-5, 1.0)
        before = np.where(turn < 0, 0.0, g)
        weights = weights + np.sign(before) * step
    return Model(weights[:n], float(weights[n]), weights[n + 1 :].reshape(2, 2))


def learned(chains: list[np.ndarray], bad: list[int]) -> Model:
    """A model from chains of levels and whether their documents are bad."""
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    chains = [chains[i] for i in order]
    y = np.repeat([bad[i] for i in order], [len(c) for c in chains])
    lines = np.concatenate(chains)
    odds = climbed(list(lines[:, None, :]), y).scores(lines)
    return climbed(chains, np.where(y == 1, odds > 0, odds > np.log(CLEAR)).astype(np.int64))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 4 << 20):
            m = measure([t or b"" for t in part.column("text").to_pylist()])
            n = np.bincount(m.text, minlength=part.num_rows)
            ends = np.r_[0, np.cumsum(n)] * len(LEVELS)
            flat = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(m.levels.reshape(-1).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([part.column("bad"), pa.array(n), flat], names=["bad", "n", "levels"])


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, sample_lines: int = SAMPLE_LINES) -> Model:
    """A model from ``doc_id, text`` and ``doc_id, quality``; the caller has left out the rows not to learn from."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.max(F.col("quality").cast("int")) == 0).cast("int").alias("bad"))
    # At most sample_rows rows of two numbers: a proven bound for the broadcast.
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(picked), "doc_id")
    found = rows.dropDuplicates(["doc_id"]).select("text", "bad").mapInArrow(tidy(_measured), "bad int, n long, levels array<int>")
    # Sorted, so that rounding does not depend on the order of the rows.
    chains = sorted((list(r["levels"]), r["bad"]) for r in found.where(F.col("n").between(1, sample_lines)).collect())
    if len({bad for _, bad in chains}) < 2:
        return Model()
    return learned([np.array(c, np.int64).reshape(-1, len(LEVELS)) for c, _ in chains], [bad for _, bad in chains])


def judge(docs: DataFrame, model: Model, share: float = SHARE) -> DataFrame:
    """Base counts, ``base_failed``, lines of either label and ``kept`` of every row of ``doc_id, text``."""
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 4 << 20):
                m = measure([t or b"" for t in part.column("text").to_pylist()])
                n = part.num_rows
                scores, ends = model.scores(m.levels).tolist(), np.cumsum(np.bincount(m.text, minlength=n)).tolist()
                bad = np.array([y for b, e in zip([0, *ends], ends, strict=False) for y in decoded(scores[b:e], model.pairs)], np.int64)
                total = np.bincount(m.text, weights=m.size, minlength=n)
                good = np.bincount(m.text, weights=m.size * (1 - bad), minlength=n)
                failed = (m.base["n_words"] < LEAST_WORDS) | (100 * m.base["n_repeat_words"] > 20 * m.base["n_words"])
                kept = ~failed & (good >= share * total)
                lines = np.bincount(m.text, minlength=n)
                marked = np.bincount(m.text, weights=bad, minlength=n).astype(np.int64)
                columns = [*(m.base[c] for c in counts), failed, kept, lines - marked, marked, good / np.maximum(total, 1)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *map(pa.array, columns)], names=["doc_id", *counts, "base_failed", "kept", "n_content", "n_boilerplate", "content_share"])

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, {', '.join(c + ' long' for c in counts)}, base_failed boolean, kept boolean, n_content long, n_boilerplate long, content_share double"
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(tidy(run), schema)
