"""Token ids as checksummed blocks, written by an adaptive context-mixing range coder.

A block holds whole documents of about ``BLOCK_TOKENS`` ids and is coded from a fresh state.  Its ids are cut into up to
``LANES`` runs that are coded in step, each with a coder state of its own, over one model that all runs teach::

    order 2   the id that last followed the two ids before, with a confidence
    order 1   the two ids that followed the id before most surely, each with a confidence
    order 0   counts of all ids so far

Their weights are learned in every step from how often they were right at that confidence, the weighted predictions add up to one
distribution per id, and a 64-bit carry-less range coder narrows to it.  Encoder and decoder run the same model code.

Block layout (little-endian)::

    magic "HTB2" | u32 crc32 of the rest | u32 sizes of the three parts | parts
    zlib: u32 n, i64 doc ids, null flags, u32 lengths
    zlib: u32 crc32 of the ids, u32 number of ids, u32 lanes, u32 words of each lane, u32 alphabet
    u32 coder words

The dataset is a Parquet table of blocks (``part, block, n_tokens, payload``): Spark's committer makes it whole although
executors are lost, and any store that Spark writes will do.  Rows are in (part, block) order by ascending doc id.

Defined cases: a null text is an empty document (its end id only); null doc ids come first; equal ids are ordered by
the md5 of their text, null first, and keep one entry each; an empty table gives no blocks; a document is never split, so one longer than a block
makes a larger block; further columns are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.llm.common import ship, slices, tidy

ship(__name__)

BLOCK_TOKENS = 1 << 21
LANES = 4096
CACHED = 600_000
_TOTAL, _ZERO = 24, 18  # bits of the whole distribution and of the order-0 table
_WHOLE = float((1 << _TOTAL) - (1 << 20))  # the most that ids of orders 1 and 2 share
_FIRST, _HASH = 2, 1 << 18  # predictions of order 1; places of order 2
_PRIOR = float(8 << _TOTAL)
_HIT = float(LANES << _TOTAL + 1)
_LOW32 = np.uint64(0xFFFFFFFF)

# ---------------------------------------------------------------- tokens

# A byte-level tokenizer that splits by the usual pattern (an optional space and letters, digits or other signs; white space)
# always splits a text before the last of some white space that is a space or a line feed, after it if it is a line feed,
# and between an ASCII letter and a sign other than an apostrophe.  ``_SOLID`` bytes begin characters that are no white space for
# certain.  Texts are cut there and each different piece is encoded once.
_SOLID, _SPACE, _LINE, _LETTER, _SIGN, _STOP = (1 << k for k in range(6))
_KINDS = bytearray(256)
for _c in (*range(0x21, 0x7F), *range(0xC3, 0xE0)):
    _KINDS[_c] = _SOLID
    if _c < 0x7F and not chr(_c).isdigit() and chr(_c) != "'":
        _KINDS[_c] |= _LETTER if chr(_c).isalpha() else _SIGN
_KINDS[32], _KINDS[10], _KINDS[0xFF] = _SPACE, _LINE, _STOP
_END = b"\xff"  # in no UTF-8 text
# Bytes of letters up to U+027F, but for the signs U+00D7 and U+00F7 among them: after at most one space they are one piece of the pattern.
_LETTERS = np.isin(np.arange(256), [*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", *range(0x80, 0xC0), *range(0xC3, 0xCA)])
# The characters that stand for bytes in the vocabulary of a byte-level tokenizer.
_CHARS = np.arange(256, dtype="<u2")
_HIDDEN = np.r_[0:33, 127:161, 173]
_CHARS[_HIDDEN] = 256 + np.arange(len(_HIDDEN))


def tokenizer_of(path: str):
    """The tokenizer of a file: one for each worker process, as the library does not give back all memory of those it drops."""
    from tokenizers import Tokenizer

    # By-value functions bring their module anew with every task; only an entry in ``sys.modules`` outlives it.
    held = sys.modules.setdefault("_hearth_worker", types.ModuleType("_hearth_worker")).__dict__.setdefault("tokenizers", {})
    if path not in held:
        # Spark has a worker on every core: the library's own threads would only wait for each other.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        held[path] = Tokenizer.from_file(path)
        held[path].encode_special_tokens = True
    return held[path]


class Encoder:
    """Ids of whole texts by the tokenizers library; pieces of texts that it encodes on their own are kept for reuse.

    Where the tokenizer is not known to split at the pieces' ends, the library is given whole texts.
    """

    def __init__(self, path: str, end_id: int | None = 2):
        self.tokenizer = tokenizer_of(path)
        self.end = np.array([] if end_id is None else [end_id], np.uint32)
        self.splits = self._known_splits()
        if self.splits:
            from tokenizers import Tokenizer
            from tokenizers.pre_tokenizers import WhitespaceSplit

            # The same model for words that need no further splitting, in the characters of its vocabulary.
            self.words = Tokenizer(self.tokenizer.model)
            self.words.pre_tokenizer = WhitespaceSplit()
            vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
            self.length = np.zeros(max(vocabulary.values()) + 1, np.int64)
            self.length[list(vocabulary.values())] = list(map(len, vocabulary))
        # Piece 0 is the end of a text.
        self.pieces: dict[bytes, int] = {_END: 0}
        self.ids, self.ends, self.met = self.end, np.array([len(self.end)]), np.zeros(1, np.int32)

    def _known_splits(self) -> bool:
        rules = json.loads(self.tokenizer.to_str())
        splitter, model = rules["pre_tokenizer"] or {}, rules["model"]
        return (
            splitter.get("type") == "ByteLevel" and splitter.get("use_regex") is True and splitter.get("add_prefix_space") is False
            and rules["normalizer"] is None and all(t["special"] for t in rules["added_tokens"]) and model["type"] == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        )

    def _forget(self) -> None:
        """Half of the pieces at least: those that the fewest batches of texts held."""
        kept = self.met > max(1, np.sort(self.met)[-1 - CACHED // 2 :][0])
        kept[0] = True
        sizes = np.diff(self.ends, prepend=0)
        self.ids, self.ends, self.met = self.ids[np.repeat(kept, sizes)], np.cumsum(sizes[kept]), np.ones(np.count_nonzero(kept), np.int32)
        self.pieces = {p: n for n, p in enumerate(compress(self.pieces, kept.tolist()))}

    def _library(self, texts: list[str], words: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and where each one's end."""
        found = [e.ids for e in (self.words if words else self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)]
        ends = np.cumsum([len(x) for x in found], dtype=np.int64)
        return np.fromiter(chain.from_iterable(found), np.uint32, int(ends[-1]) if found else 0), ends

    def _cut(self, ids: np.ndarray, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where each piece's ids end: a byte-level token is as long as its bytes are many."""
        ends, wanted = np.cumsum(self.length[ids]), np.cumsum(list(map(len, pieces)))
        cuts = np.searchsorted(ends, wanted) + 1
        if cuts[-1] > len(ids) or not np.array_equal(ends[cuts - 1], wanted):
            raise ValueError("the tokenizer joins pieces that it was expected to split")
        return ids, cuts

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        """Numbers of new pieces.  Words, and pieces that begin with a space, are encoded many at once: the tokenizer splits between them."""
        body = np.frombuffer(b"".join(pieces), np.uint8)
        starts = np.cumsum([0, *map(len, pieces[:-1])])
        other = ~_LETTERS[body]
        other[1:] |= (body[:-1] == 0xC3) & ((body[1:] == 0x97) | (body[1:] == 0xB7))
        other[starts] &= body[starts] != 32
        word = np.logical_or.reduceat(other, starts)
        np.logical_not(word, out=word)
        spaced = np.fromiter((p[0] == 32 and len(p) > 1 and _KINDS[p[1]] & _SOLID for p in pieces), bool, len(pieces)) & ~word
        numbers = np.empty(len(pieces), np.int64)
        for chosen in (word, spaced, ~(word | spaced)):
            some = list(compress(pieces, chosen.tolist()))
            if not some:
                continue
            groups = [some[i : i + 500] for i in range(0, len(some), 500)]
            if chosen is word:
                ids, ends = self._cut(self._library([_in_characters(g) for g in groups], True)[0], some)
            elif chosen is spaced:
                ids, ends = self._cut(self._library([b"".join(g).decode("utf-8", "surrogatepass") for g in groups])[0], some)
            else:
                ids, ends = self._library([p.decode("utf-8", "surrogatepass") for p in some])
            n = len(self.pieces)
            numbers[chosen] = np.arange(n, n + len(some))
            self.pieces.update(zip(some, range(n, n + len(some)), strict=True))
            self.ids, self.ends = np.concatenate([self.ids, ids]), np.concatenate([self.ends, ends + len(self.ids)])
        self.met = np.concatenate([self.met, np.zeros(len(pieces), np.int32)])
        return numbers

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        ids, ends = self._library(texts)
        return [np.concatenate([x, self.end]) for x in np.split(ids, ends[:-1])] if texts else []

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        if not self.splits or not texts:
            return self._whole([t or "" for t in texts])
        body = _END.join([*((t or "").encode("utf-8", "surrogatepass") for t in texts), b""])
        kind = np.frombuffer(body.translate(_KINDS), np.uint8)
        solid = kind[1:] & _SOLID
        line = kind[:-1] // _LINE & solid
        gap = np.zeros(len(body) + 1, np.uint8)
        gap[0] = 1
        gap[:-2] |= kind[:-1] // _SPACE & solid | line
        gap[1:-1] |= line | kind[:-1] // _LETTER & kind[1:] // _SIGN & 1
        gap[:-1] |= kind & _STOP
        gap[1:] |= kind & _STOP
        offsets = np.flatnonzero(gap).astype(np.int32)
        cut = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(body)]).dictionary_encode()
        del kind, solid, line, gap, offsets
        which, (_, places, held) = cut.indices.to_numpy(), cut.dictionary.buffers()
        places, held = np.frombuffer(places, np.int32, len(cut.dictionary) + 1).tolist(), held.to_pybytes()
        unique = [held[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]
        if len(self.pieces) > CACHED:
            self._forget()
        number = np.fromiter(map(self.pieces.get, unique, repeat(-1)), np.int64, len(unique))
        new = number < 0
        if new.any():
            number[new] = self._learn(list(compress(unique, new.tolist())))
        self.met[number] += 1
        begin = np.r_[0, self.ends[:-1]][number]
        size = self.ends[number] - begin
        n = size[which]
        stops = np.cumsum(n)
        at = np.arange(int(stops[-1]))
        at += np.repeat(begin[which] - (stops - n), n)
        return np.split(self.ids[at], stops[which == unique.index(_END)][:-1])


def _in_characters(words: list[bytes]) -> str:
    """One word a line, each byte as its character in the vocabulary."""
    body = np.frombuffer(b"\n".join(words), np.uint8)
    return np.where(body == 10, np.uint16(10), _CHARS[body]).astype("<u2").tobytes().decode("utf-16-le")


def encoder_of(path: str, end_id: int | None) -> Encoder:
    """The encoder of a file and an end id: one for each worker process, so that pieces that one task has met are known to the next."""
    tokenizer_of(path)
    held = vars(sys.modules["_hearth_worker"]).setdefault("encoders", {})
    if (path, end_id) not in held:
        held[path, end_id] = Encoder(path, end_id)
    return held[path, end_id]


# ---------------------------------------------------------------- model and coder


def _mask(chosen: np.ndarray, kind: type) -> np.ndarray:
    """All bits where chosen, else none."""
    mask = chosen.astype(kind)
    return np.negative(mask, out=mask)


def _put(into: np.ndarray, values: np.ndarray, mask: np.ndarray) -> None:
    """Values of the mask's places.  Bits are faster than a condition for each lane, whose outcome no processor foresees."""
    values = into ^ values
    values &= mask
    into ^= values


class _Model:
    """Weighted predictions of the next symbol of every lane; taught with the symbols of all lanes at once.

    A prediction is an id and its confidence, held as one number (id * 16 + confidence).  Every prediction has the weight of its
    rank and confidence, the counts of order 0 have weight 1, and shares are weights by their sum.  A weight grows
    by how often its ids came against the share they were given, in every step.  All arithmetic is that of integers
    or sums, products and quotients of doubles in a fixed order, so that every machine decodes what any machine encoded.
    """

    def __init__(self, symbols: int, lanes: int, inverse: bool):
        self.n, self.inverse, self.step = symbols, inverse, 0
        self.count = np.ones(symbols, np.int64)
        self.two, self.one = np.zeros(_HASH, np.int32), np.zeros((_FIRST, symbols), np.int32)
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.t, self.rank = np.zeros((1 + _FIRST, lanes), np.int32), np.arange(1 + _FIRST, dtype=np.int32)[:, None] * 16
        self.weight = np.full((1 + _FIRST) * 16, 0.05)
        self.weight[:16] += np.arange(16) * 0.2
        self.waiting: list[np.ndarray] = []

    def _refresh(self) -> None:
        if self.waiting:
            self.count += np.bincount(np.concatenate(self.waiting), minlength=self.n)
            self.waiting = []
        room = (1 << _ZERO) - self.n
        freq = 1 + self.count * room // int(self.count.sum())
        freq[int(self.count.argmax())] += (1 << _ZERO) - int(freq.sum())
        self.cum = np.zeros(self.n + 1, np.int64)
        np.cumsum(freq, out=self.cum[1:])
        if self.inverse:
            self.slot = np.repeat(np.arange(self.n, dtype=np.uint16 if self.n <= 1 << 16 else np.int32), freq)

    def predict(self) -> None:
        if self.step < 16 or self.step % 8 == 0:
            self._refresh()
        self.h = (self.last * 40503 + self.before * 12289) & (_HASH - 1)
        self.two.take(self.h, out=self.t[0], mode="clip")
        for one, t in zip(self.one, self.t[1:], strict=True):
            one.take(self.last, out=t, mode="clip")
        self.id, self.c = self.t >> 4, self.t & 15
        self.cell = (self.c + self.rank).astype(np.int64)
        w = self.weight.take(self.cell)
        for k in range(1, 1 + _FIRST):  # one id, one share: order 1 adds its weight where order 2 says the same
            moved = w[k] * (self.id[k] == self.id[0]).astype(np.float64)
            w[0] += moved
            w[k] -= moved
        whole = w[0] + w[1]
        for k in range(2, 1 + _FIRST):
            whole += w[k]
        whole += 1.0
        w *= np.divide(_WHOLE, whole, out=whole)
        np.floor(w, out=w)
        self.given, self.share = w, w.astype(np.int64)
        self.ends = [self.share[0]]
        for share in self.share[1:]:
            self.ends.append(self.ends[-1] + share)
        self.rest = (1 << _TOTAL) - self.ends[-1]

    def interval(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of the symbols' parts of the distribution."""
        low, high = self.cum.take(s), self.cum.take(s + 1)
        low = self.ends[-1] + (low * self.rest >> _ZERO)
        size = self.ends[-1] + (high * self.rest >> _ZERO) - low
        self.right = self.id == s.astype(np.int32)
        self.hit = self.right & (self.share > 0)
        for begin, share, mask in zip((np.int64(0), *self.ends[:-1]), self.share, _mask(self.hit, np.int64), strict=True):
            _put(low, begin, mask)
            _put(size, share, mask)
        return low, size

    def symbol(self, t: np.ndarray) -> np.ndarray:
        # Both numbers are below 2**42, so the quotient's floor is exact in float64, which divides faster.
        u = np.maximum(t - self.ends[-1], 0)
        s = self.slot.take((((u + 1 << _ZERO) - 1) / self.rest).astype(np.int64)).astype(np.int64)
        for end, id_ in zip(self.ends[::-1], self.id[::-1], strict=True):
            _put(s, id_.astype(np.int64), _mask(t < end, np.int64))
        return s

    def teach(self, s: np.ndarray) -> None:
        # Hits and shares in one sum: whole numbers, exact in doubles, as the shares of all lanes are below _HIT.
        both = self.hit.astype(np.float64)
        both *= _HIT
        both += self.given
        both = np.bincount(self.cell.reshape(-1), weights=both.reshape(-1), minlength=len(self.weight))
        came = np.floor(both / _HIT)
        given = both - came * _HIT
        came *= float(1 << _TOTAL)
        self.weight *= (came + given + _PRIOR) / (2.0 * given + _PRIOR)
        self.waiting.append(s)
        fresh = s.astype(np.int32) << 4
        # A right prediction gains confidence; the last one of its order ages by a miss, then gives way to the id that came.
        right, c = self.right, self.c
        up = (right & (c < 15)).astype(np.int32)
        up += self.t
        for k, wrong in ((0, ~right[0]), (-1, ~np.logical_or.reduce(right[1:]))):
            new = self.t[k] - c[k] + (c[k] >> 1)
            _put(new, fresh, _mask(c[k] <= 1, np.int32))
            _put(up[k], new, _mask(wrong, np.int32))
        self.two[self.h] = up[0]
        for k in range(len(up) - 1, 1, -1):  # the surer one first
            rises = np.flatnonzero((up[k] & 15) > (up[k - 1] & 15))
            up[k][rises], up[k - 1][rises] = up[k - 1][rises], up[k][rises]
        for one, new in zip(self.one, up[1:], strict=True):
            one[self.last] = new
        self.before, self.last = self.last, s
        self.step += 1


def _lanes(n: int) -> int:
    return max(1, min(LANES, n // 64))


def _narrowed(low: np.ndarray, size: np.ndarray, need: np.ndarray) -> None:
    """Shift the leading word out of the lanes ``need``; where a carry could still change it, the size gives way."""
    at, left = low[need], size[need]
    left = np.minimum(left, (_LOW32 - (at & _LOW32)) + np.uint64(1))
    low[need] = at << np.uint64(32)
    size[need] = left << np.uint64(32)


def encode_symbols(symbols: np.ndarray, alphabet: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of words of each lane, and the lanes' words one after the other."""
    n = len(symbols)
    lanes = _lanes(n)
    steps = -(-n // lanes)
    grid = np.zeros(lanes * steps, np.int64)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    model = _Model(alphabet, lanes, False)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    who, words = [], []
    for s in grid:
        model.predict()
        start, part = model.interval(s)
        size >>= np.uint64(_TOTAL)
        low += size * start.view(np.uint64)
        size *= part.view(np.uint64)
        need = np.flatnonzero(size <= _LOW32)
        if len(need):
            who.append(need)
            words.append((low[need] >> np.uint64(32)).astype(np.uint32))
            _narrowed(low, size, need)
        model.teach(s)
    # One more word names a number in each lane's last part, which is wider than a word; what would follow reads as zeros.
    who.append(np.arange(lanes))
    words.append((low + _LOW32 >> np.uint64(32)).astype(np.uint32))
    who_all, words_all = np.concatenate(who), np.concatenate(words)
    order = np.argsort(who_all.astype(np.uint16), kind="stable")  # lanes are few: a radix sort
    return np.bincount(who_all, minlength=lanes).astype(np.uint32), words_all[order]


def decode_symbols(n: int, counts: np.ndarray, words: np.ndarray, alphabet: int) -> np.ndarray:
    lanes = len(counts)
    steps = -(-n // lanes)
    stop = np.cumsum(counts, dtype=np.int64)
    at = stop - counts
    stream = np.r_[words, np.uint32(0)].astype(np.uint64)

    def word(which) -> np.ndarray:
        out = np.where(at[which] < stop[which], stream[np.minimum(at[which], len(words))], np.uint64(0))
        at[which] += 1
        return out

    code = word(slice(None)) << np.uint64(32)
    code |= word(slice(None))
    model = _Model(alphabet, lanes, True)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    out = np.empty((steps, lanes), np.int32)
    top = np.int64((1 << _TOTAL) - 1)
    for k in range(steps):
        model.predict()
        size >>= np.uint64(_TOTAL)
        s = model.symbol(np.minimum(((code - low) // size).view(np.int64), top))
        start, part = model.interval(s)
        low += size * start.view(np.uint64)
        size *= part.view(np.uint64)
        need = np.flatnonzero(size <= _LOW32)
        if len(need):
            code[need] = code[need] << np.uint64(32) | word(need)
            _narrowed(low, size, need)
        model.teach(s)
        out[k] = s
    return out.T.reshape(-1)[:n]


# ---------------------------------------------------------------- blocks

_MAGIC = b"HTB2"


def write_block(doc_ids: list[int | None], ids: list[np.ndarray]) -> bytes:
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
    alphabet = np.flatnonzero(np.bincount(flat)) if len(flat) else np.zeros(0, np.int64)
    place = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 0, np.int64)
    place[alphabet] = np.arange(len(alphabet))
    heads = np.array([d or 0 for d in doc_ids], "<i8").tobytes() + bytes(d is None for d in doc_ids) + np.array([len(x) for x in ids], "<u4").tobytes()
    crc = zlib.crc32(flat.astype("<u4").tobytes())
    counts, words = encode_symbols(place.take(flat), len(alphabet)) if len(flat) else (np.zeros(0, np.uint32),) * 2
    parts = (
        zlib.compress(struct.pack("<I", len(doc_ids)) + heads, 1),
        zlib.compress(struct.pack("<3I", crc, len(flat), len(counts)) + counts.astype("<u4").tobytes() + alphabet.astype("<u4").tobytes(), 1),
        words.astype("<u4").tobytes(),
    )
    body = struct.pack("<3I", *map(len, parts)) + b"".join(parts)
    return _MAGIC + struct.pack("<I", zlib.crc32(body)) + body


def read_block(payload: bytes) -> tuple[list[int | None], list[np.ndarray]]:
    body = payload[8:]
    if payload[:4] != _MAGIC or struct.unpack("<I", payload[4:8])[0] != zlib.crc32(body):
        raise ValueError("damaged token block")
    a, b, c = struct.unpack("<3I", body[:12])
    head, letters, words = zlib.decompress(body[12 : 12 + a]), zlib.decompress(body[12 + a : 12 + a + b]), body[12 + a + b : 12 + a + b + c]
    (n,) = struct.unpack("<I", head[:4])
    docs = np.frombuffer(head, "<i8", n, 4).tolist()
    missing, lengths = head[4 + 8 * n : 4 + 9 * n], np.frombuffer(head, "<u4", n, 4 + 9 * n)
    crc, size, lanes = struct.unpack("<3I", letters[:12])
    counts, alphabet = np.split(np.frombuffer(letters, "<u4", -1, 12), [lanes])
    flat = alphabet[decode_symbols(size, counts, np.frombuffer(words, "<u4"), len(alphabet))] if size else np.zeros(0, "<u4")
    if zlib.crc32(np.ascontiguousarray(flat, "<u4").tobytes()) != crc:
        raise ValueError("decoded ids do not match their checksum")
    cuts = np.cumsum(lengths)[:-1]
    return [None if missing[i] else docs[i] for i in range(n)], np.split(flat, cuts) if n else []


def encode(docs: DataFrame, tokenizer_path: str, end_id: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``part, block, n_docs, n_tokens, payload`` in ascending order of ``doc_id`` over (part, block)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_texts, part, block = encoder_of(tokenizer_path, end_id), TaskContext.get().partitionId(), 0
        held_docs: list = []
        held_ids: list = []
        held = 0

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([len(held_docs)], pa.int64()), pa.array([held], pa.int64()),
                 pa.array([write_block(held_docs, held_ids)], pa.binary())], names=["part", "block", "n_docs", "n_tokens", "payload"],
            )

        for batch in batches:
            for piece in slices(batch, "text", 8 << 20):
                for doc, ids in zip(piece.column("doc_id").to_pylist(), encode_texts(piece.column("text").to_pylist()), strict=True):
                    held_docs.append(doc)
                    held_ids.append(ids)
                    held += len(ids)
                    if held >= block_tokens:
                        yield made()
                        held_docs, held_ids, held, block = [], [], 0, block + 1
        if held_docs:
            yield made()

    # The text's hash and the row's number part the rows of an id that many share.
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.md5("text").alias("fp"), F.monotonically_increasing_id().alias("row"))
    ordered = numbered.repartitionByRange("doc_id", "fp", "row").sortWithinPartitions("doc_id", "fp", "row").select("doc_id", "text")
    return ordered.mapInArrow(tidy(run), "part int, block int, n_docs long, n_tokens long, payload binary")


def decode(blocks: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document in the blocks."""
    per_part = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    # One row per written part.
    bases = per_part.select("part", F.coalesce(F.sum("n").over(ahead(Window.partitionBy(F.lit(1)).orderBy("part"))), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n_tokens").over(ahead(Window.partitionBy("part").orderBy("block"))), F.lit(0))
    at = blocks.select("part", "block", inside.alias("inside")).join(bases, "part").select("part", "block", (F.col("base") + F.col("inside")).alias("start"))
    placed = blocks.join(at, ["part", "block"]).select("start", "payload")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                docs, ids = read_block(batch.column("payload")[i].as_py())
                lengths = np.array([len(x) for x in ids], np.int64)
                starts = batch.column("start")[i].as_py() + np.r_[0, np.cumsum(lengths)[:-1]] if len(ids) else lengths
                crcs = [zlib.crc32(np.ascontiguousarray(x, "<u4").tobytes()) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(starts, pa.int64()), pa.array(lengths), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return placed.mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def write(blocks: DataFrame, path: str) -> None:
    blocks.write.mode("overwrite").option("compression", "uncompressed").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
