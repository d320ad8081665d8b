"""Personal data: base patterns with checks, and a skip-chain conditional random field over number-like tokens.

Base spans come from fixed patterns (e-mail, IPv4, card, phone), matched leftmost and non-overlapping per kind in linear
time.  The field labels the *candidate* tokens of a document, those holding a digit or an ``@``; all other tokens are
fixed to "none" and so cut the chain into independent pieces.  Its factors are: one per token (label given shape), one per
pair of candidate tokens that follow each other (chain), and one per pair of a token and a hub of its like tokens (skip).
Tokens are like if they have the same characters or, from seven digits on, the same last seven digits.  Tokens in base
spans are evidence.  The hubs of a group of like tokens are its first token of every kind of evidence, or its first token
where it holds no evidence: evidence speaks to every like mention at once, however many lie between, and a token adds at
most one edge a kind.  Sum-product messages are passed over the loopy graph until none changes by more than ``BOUND``; where
they circle, the steps shrink, and after ``LIMIT`` rounds the last beliefs stand.  Tokens whose marginal favours a kind
become further spans, adjacent tokens of one kind as one span but for those that their check digit makes whole.  Base spans always
stay.  What the field adds is mostly what a pattern loses by taking in a neighbour, as patterns are not tried again.

The weights are estimated piecewise (each factor's own likelihood, in closed form from smoothed counts) on at most
``SAMPLE_ROWS`` documents, the first by a hash of their id, with the base spans as labels.  The skip factor is counted on
each token and its last like token, so that a group counts by its size.

Defined cases: null texts count as empty; a document without candidates has no spans; repeated rows are handled row by
row; an empty table gives an empty result and untrained factors are neutral; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearth.llm.common import ship, slices, tidy

ship(__name__)

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 5_000
BOUND, LIMIT = 1e-8, 10_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_CANDIDATE = re.compile(r"[^\s,;|\"']*[0-9@][^\s,;|\"']*+")
_DIGIT = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        if domain:
            begin = at
            while begin > free and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < at:
                yield begin, domain.end()
                free = domain.end()
        at = text.find("@", max(at + 1, free))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for run in _DOTTED.finditer(text):
        parts = run.group().split(".")
        at = run.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                yield at, end
            at = end + 1


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_DIGIT.findall(m.group())) <= 15:
                yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every base span, by start, then kind."""
    found = [(a, 0, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for kind, find in ((1, ips), (2, cards), (3, phones)):
            found += [(a, kind, b) for a, b in find(text)]
    return sorted(found)


def tokens(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _CANDIDATE.finditer(text)]


def shape(token: str) -> str:
    """A bounded description of a token: its digits in steps, whether they pass Luhn, letters and the marks of the kinds."""
    digits = len(_DIGIT.findall(token))
    step = sum(digits > n for n in (0, 3, 6, 9, 13, 19))
    letters = any(c.isalpha() for c in token)
    sound = 14 <= digits <= 19 and not letters and luhn("".join(_DIGIT.findall(token)))
    return f"{step}{'L' * sound}{'a' * letters}{'@' * ('@' in token)}{'+' * token.startswith('+')}{'(' * ('(' in token)}{'-' * ('-' in token)}{'.' * min(4, token.count('.'))}"


def likeness(token: str) -> str:
    digits = "".join(_DIGIT.findall(token))
    return "d" + digits[-7:] if len(digits) >= 7 else "t" + token.strip(".,()").lower()


def graph(text: str) -> tuple[list[tuple[int, int]], list[int], list[tuple[int, int]], list[list[int]], list[tuple[int, int, int]]]:
    """Tokens, their evidence (0 none, else 1 + kind), chain edges, groups of like tokens and base spans."""
    base, spans = base_spans(text), tokens(text)
    label, j = [], 0
    ordered = sorted(base, key=lambda s: s[2])
    for a, b in spans:
        while j < len(ordered) and ordered[j][2] <= a:
            j += 1
        label.append(next((1 + k for s, k, e in ordered[j : j + 4] if s < b and e > a), 0))
    chain = [(i, i + 1) for i in range(len(spans) - 1) if not text[spans[i][1] : spans[i + 1][0]].strip()]
    groups: dict[str, list[int]] = {}
    for i, (a, b) in enumerate(spans):
        groups.setdefault(likeness(text[a:b]), []).append(i)
    return spans, label, chain, [g for g in groups.values() if len(g) > 1], base


def pairs(chain: list[tuple[int, int]], groups: list[list[int]]) -> list[tuple[int, int]]:
    """Every token and its last like token, but for those that follow each other: what the skip factor is counted on."""
    linked = set(chain)
    return [e for g in groups for e in zip(g, g[1:]) if e not in linked]


def skips(label: list[int], chain: list[tuple[int, int]], groups: list[list[int]]) -> list[tuple[int, int]]:
    """Edges, earlier token first, from the hubs of each group to its tokens without evidence."""
    linked, out = set(chain), []
    for g in groups:
        hubs: dict[int, int] = {}
        for i in g:
            if label[i]:
                hubs.setdefault(label[i], i)
        for i in g:
            if not label[i]:
                # Two open tokens that follow each other have the chain's factor; evidence speaks to its neighbours as well.
                out += [(min(h, i), max(h, i)) for h in hubs.values()] or [e for e in ((g[0], i),) if g[0] != i and e not in linked]
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()
    for batch in batches:
        for text in batch.column("text").to_pylist():
            text = text or ""
            spans, label, chain, groups, _ = graph(text)
            for (a, b), y in zip(spans, label, strict=True):
                seen["node", shape(text[a:b]), y, 0] += 1
            for name, edges in (("chain", chain), ("skip", pairs(chain, groups))):
                for i, j in edges:
                    seen[name, "", label[i], label[j]] += 1
    keys = sorted(seen)
    yield pa.RecordBatch.from_pydict(
        {
            "factor": pa.array([k[0] for k in keys], pa.string()), "shape": pa.array([k[1] for k in keys], pa.string()),
            "a": pa.array([k[2] for k in keys], pa.int32()), "b": pa.array([k[3] for k in keys], pa.int32()),
            "n": pa.array([seen[k] for k in keys], pa.int64()),
        }
    )


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> dict:
    """Log factors: ``node`` by shape (5 labels), ``chain`` and ``skip`` (5 x 5)."""
    # The ids are picked first, so that no text is sorted; at most sample_rows ids bound the broadcast.
    picked = docs.where(F.col("text").rlike("[0-9@]")).select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    sample = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    counted = sample.select("text").mapInArrow(tidy(_counts), "factor string, shape string, a int, b int, n long")
    rows = counted.groupBy("factor", "shape", "a", "b").agg(F.sum("n").alias("n")).collect()
    n = 1 + len(KINDS)
    node: dict[str, np.ndarray] = {}
    pair = {"chain": np.ones((n, n)), "skip": np.ones((n, n))}
    for r in rows:
        if r["factor"] == "node":
            node.setdefault(r["shape"], np.full(n, 0.5))[r["a"]] += r["n"]
        else:
            pair[r["factor"]][r["a"], r["b"]] += r["n"]
    seen = sum(node.values(), np.zeros(n)) if node else np.ones(n)
    return {
        "node": {k: np.log(v / v.sum()).tolist() for k, v in node.items()},
        # Shapes that the sample does not hold.
        "prior": np.log(seen / seen.sum()).tolist(),
        # Association beyond chance, so that a factor without evidence is neutral.
        **{k: np.log(v * v.sum() / np.outer(v.sum(1), v.sum(0))).tolist() for k, v in pair.items()},
    }


def marginals(n: int, unary: np.ndarray, edges: list[tuple[int, int, np.ndarray]], rounds: int = LIMIT) -> np.ndarray:
    """Sum-product beliefs of ``n`` nodes: damped loopy message passing, all edges at once, until no message changes."""
    labels = unary.shape[1]
    if not edges:
        out = np.exp(unary - unary.max(1, keepdims=True))
        return out / out.sum(1, keepdims=True)
    i, j = np.array([e[0] for e in edges]), np.array([e[1] for e in edges])
    factor = np.exp(np.stack([e[2] for e in edges]))
    source, target = np.r_[i, j], np.r_[j, i]
    both = np.concatenate([factor, factor.transpose(0, 2, 1)])  # message s -> t: sum over the labels of s
    m, half = np.zeros((len(source), labels)), len(edges)
    back = np.r_[np.arange(half, 2 * half), np.arange(half)]
    step = 0.5
    for done in range(1, rounds + 1):
        belief = unary.copy()
        np.add.at(belief, target, m)
        out = belief[source] - m[back]
        out = np.exp(out - out.max(1, keepdims=True))
        new = np.log(np.einsum("es,est->et", out, both) + 1e-300)
        new -= new.max(1, keepdims=True)
        change = np.abs(new - m).max()
        m += step * (new - m)
        if change <= BOUND:
            break
        if done % 1000 == 0:
            step /= 2
    belief = unary.copy()
    np.add.at(belief, target, m)
    out = np.exp(belief - belief.max(1, keepdims=True))
    return out / out.sum(1, keepdims=True)


def all_spans(text: str, model: dict) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and base and field spans together, both as (start, kind, end) by start, then kind."""
    spans, label, chain, groups, base = graph(text)
    skip = skips(label, chain, groups)
    if all(label):
        return base, base
    shapes = [shape(text[a:b]) for a, b in spans]
    unary = np.array([model["node"].get(s, model["prior"]) for s in shapes])
    for t, y in enumerate(label):
        if y:
            unary[t] = -np.inf
            unary[t, y] = 0.0
    factor = {name: np.array(model[name]) for name in ("chain", "skip")}
    edges = [(i, j, factor["chain"]) for i, j in chain] + [(i, j, factor["skip"]) for i, j in skip]
    best = marginals(len(spans), unary, edges).argmax(1)
    added: list[tuple[int, int, int]] = []
    linked = set(chain)
    for t, (a, b) in enumerate(spans):
        if label[t] or not best[t]:
            continue
        a += len(text[a:b]) - len(text[a:b].lstrip("(<["))
        b -= len(text[a:b]) - len(text[a:b].rstrip(".:)>]!?"))
        # A token that is a whole number by its check digit stands alone; parts of one, as of a phone number, are one span.
        whole = "L" in shapes[t] or (t and "L" in shapes[t - 1])
        if added and t and (t - 1, t) in linked and not label[t - 1] and best[t - 1] == best[t] and not whole:
            added[-1] = (added[-1][0], added[-1][1], b)
        elif a < b:
            added.append((a, int(best[t]) - 1, b))
    return base, sorted(base + added)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, counts of base spans, ``base_sha256`` and ``spans`` of every row of ``doc_id, text``."""
    empty = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 8 << 20):
                held = pc.match_substring_regex(part.column("text"), "[0-9@]").fill_null(False)
                counts, digest, spans = np.zeros((part.num_rows, len(KINDS)), np.int64), [empty] * part.num_rows, [""] * part.num_rows
                for i in np.flatnonzero(held.to_numpy(zero_copy_only=False)):
                    base, every = all_spans(part.column("text")[i].as_py(), model)
                    for _, k, _ in base:
                        counts[i, k] += 1
                    digest[i], spans[i] = hashlib.sha256(written(base).encode()).hexdigest(), written(every)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(counts[:, k]) for k in range(len(KINDS))), pa.array(digest, pa.string()), pa.array(spans, pa.string())],
                    names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(tidy(run), f"doc_id {kind}, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string")
