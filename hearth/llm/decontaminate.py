"""Benchmark decontamination by the CGK embedding, bit-sampling LSH and exact edit distance.

Texts are read as sequences of words (``shingles.word_hashes``), where each character of a script without spaces is a word.
A document is contaminated by an item of n words if one of its stretches is within floor(``tolerance`` * n) word edits of it.

1. *Windows.*  A window starts at a word of a document and is as long as an item.  Items of more than ``LONGEST`` words are cut
   into equal parts of at most that many (one part has no more than its share of the edits), and sizes are dealt to classes, so that
   a start has one window for each class.  Windows are laid where they can match at all: by the q-gram lemma a stretch within k edits
   of n words keeps n - q + 1 - kq of its runs of q words, and a window with fewer runs that occur in any item is left out.
2. *Embedding.*  The CGK walk reads a window with a pointer; at step j it writes the word under the pointer and moves
   on if the coin of (repetition, j, word) says so.  Equal words toss equal coins, so after an edit the two walks meet
   again, and the edit distance becomes a Hamming distance over the written words.
3. *LSH.*  Each of ``REPEATS`` repetitions has coins of its own and samples ``SAMPLED`` steps of each class.  Class, repetition and
   sampled words make a key; documents and items are joined on their keys, and whoever shares a key is a candidate.  If a share p
   of the steps agrees at one start, recall is 1 - (1 - p^2)^24, that is 0.98 at p = 0.4; recall is tested against brute force.
4. *Verification.*  Bit-parallel semi-global edit distance of the whole item over the stretch around its candidates, exactly.

Which runs and which keys the items have is sent out as two bitmaps of at most ``MOST_BITS`` bits each (the proven bound of what the driver
holds and sends); a wrong bit costs work and loses nothing, as the join decides.  Items are never collected, and items that are
equal are searched once.  Documents are read one by one, whole; only those with a key in the bitmap are written on.

Defined cases: null and empty texts and items match nothing; items of fewer than five words match exactly, as the tolerance
leaves them no edit; equal items and repeated rows are matched each; ids may be null and of any type; an empty table on either
side gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import cut, free_name, hot_keys, ship, slices, spread_join, tidy, work_path
from hearth.llm.shingles import _BASE, mix, word_hashes

ship(__name__)

TOLERANCE = 0.2
REPEATS, SAMPLED = 24, 2
LONGEST = 64  # words of a window
SEED = 3  # words of a run
LOWS = (1, 2, 3, 4, 5, 6, 7, 9, 11, 14, 17, 21, 25, 30, 36, 43, 52, LONGEST + 1)  # least size of each class
AT_ONCE = 1024  # windows embedded together
LEAST_BITS, MOST_BITS, SPARSE = 1 << 16, 1 << 28, 512  # bits of a bitmap; bits for each hash in it
# Thai and Lao, Myanmar, Khmer, kana, Han.
_UNSPACED = re.compile("([\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff])")


def sequences(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """``word_hashes`` with each character of a script without spaces as a word."""
    return word_hashes([t if t is None or t.isascii() else _UNSPACED.sub(r" \1 ", t) for t in texts])


def runs(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each position on."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = out * np.uint64(_BASE) + words[k : n + k]
    return mix(out)


def edit_search(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the whole item to any stretch of the text, and the first end of such a stretch (bit-parallel)."""
    n = len(item)
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best = full, 0, n, (n, 0)
    for j, w in enumerate(text.tolist()):
        equal = masks.get(w, 0)
        x = equal | down
        d0 = (((equal & up) + up) ^ up) | x
        hp = down | ~(d0 | up) & full
        hn = up & d0
        score += (hp & top > 0) - (hn & top > 0)
        hp = hp << 1 & full
        up = (hn << 1 & full) | ~(d0 | hp) & full
        down = hp & d0
        if score < best[0]:
            best = (score, j + 1)
    return best


class Sizes:
    """What a class of window sizes needs: the words of a run, the runs it must share, the reach of a stretch."""

    def __init__(self, number: int, tolerance: float):
        every = np.arange(LOWS[number], LOWS[number + 1])
        edits = np.floor(tolerance * every + 1e-9).astype(np.int64)
        self.number, self.low = number, LOWS[number]
        self.width = int(np.minimum(SEED, -(-(every - edits) // (edits + 1))).min())
        self.need = max(1, int((every - self.width + 1 - edits * self.width).min()))
        self.reach = int((every + edits).max())


def parts(n: int) -> list[tuple[int, int]]:
    """(offset, size) of the equal parts of at most ``LONGEST`` words."""
    count = -(-n // LONGEST)
    edges = [n * i // count for i in range(count + 1)] if n else [0]
    return [(a, b - a) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def class_of(size: int) -> int:
    return int(np.searchsorted(LOWS, size, "right")) - 1


def samples(low: int) -> np.ndarray:
    """(REPEATS x SAMPLED) the steps that are sampled, within the walk over ``low`` words (about two steps a word)."""
    draws = mix(np.arange(REPEATS * SAMPLED, dtype=np.uint64) + np.uint64(17))
    return np.floor((draws >> np.uint64(11)).astype(np.float64) * 2.0**-53 * 1.7 * low).astype(np.int64).reshape(REPEATS, SAMPLED)


def keys(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, sizes: Sizes) -> np.ndarray:
    """(windows x REPEATS) keys of the windows that start there; words from ``ends`` on read as none."""
    out = np.empty((len(starts), REPEATS), np.uint64)
    wanted = samples(sizes.low)
    salt = mix(np.arange(1, REPEATS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    for begin in range(0, len(starts), AT_ONCE):
        first, stop = starts[begin : begin + AT_ONCE], ends[begin : begin + AT_ONCE]
        room = np.minimum(sizes.low, stop - first)[:, None]
        place = np.unique((first[:, None] + np.arange(sizes.low)).reshape(-1))
        place = place[place < len(words)]
        held = np.r_[words[place], np.uint64(0)]
        where = np.searchsorted(place, first)[:, None]  # a window's places are consecutive
        tosses = mix(held[None, :] ^ salt[:, None])
        tosses = np.stack([tosses, mix(tosses ^ np.uint64(0x5851F42D4C957F2D))]).reshape(2, -1)
        line = (np.arange(REPEATS) * len(held))[None, :]
        pointer = np.zeros((len(first), REPEATS), np.int64)
        found = np.zeros((SAMPLED, len(first), REPEATS), np.uint64)
        for step in range(int(wanted.max()) + 1):
            inside = pointer < room
            at = np.where(inside, where + pointer, len(held) - 1)
            for repeat, nth in zip(*np.nonzero(wanted == step), strict=True):
                found[nth, :, repeat] = held[at[:, repeat]]
            at += line
            pointer += (tosses[step >> 6].take(at) >> np.uint64(step & 63) & np.uint64(1)).view(np.int64) & inside
        made = mix((salt + np.uint64(sizes.number))[None, :] + found[0])
        for nth in range(1, SAMPLED):
            made = mix(made * np.uint64(_BASE) + found[nth])
        out[begin : begin + AT_ONCE] = made
    return out


def _has(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _items_read(tolerance: float):
    """Words, classes, runs and keys of each item text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                words, counts = sequences(piece.column("text").to_pylist())
                rows = []
                for text in np.split(words, np.cumsum(counts)[:-1]):
                    held, probes = set(), []
                    for offset, size in parts(len(text)):
                        kind = Sizes(class_of(size), tolerance)
                        held.add((kind.number, kind.width))
                        made = keys(text, np.array([offset]), np.array([len(text)]), kind)[0]
                        probes += [{"key": int(k), "offset": offset} for k in np.unique(made.view(np.int64))]
                    seen = np.concatenate([np.zeros(0, np.uint64), *(runs(text, w) for w in {w for _, w in held})])
                    rows.append((text.view(np.int64), sorted(k for k, _ in held), np.unique(seen).view(np.int64), probes))
                columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(_ITEM_TYPES)]
                yield pa.RecordBatch.from_arrays([piece.column("item"), *columns], names=["item", "words", "kinds", "runs", "probes"])

    return run


_ITEM_TYPES = (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.struct([("key", pa.int64()), ("offset", pa.int64())])))


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """The bitmap of a column of hashes, as bytes: ``SPARSE`` bits a hash at least, between the two bounds."""
    column: Column = F.col(hashes.columns[0])
    n = hashes.count()
    size = min(MOST_BITS, max(LEAST_BITS, 1 << (SPARSE * n - 1).bit_length())) if n else LEAST_BITS
    at = column.bitwiseAND(F.lit(size - 1))
    # One number for 64 bits: at most MOST_BITS / 64 rows.
    words = hashes.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
    found = words.toArrow()
    out = np.zeros(size >> 6, np.int64)
    out[found["w"].to_numpy()] = found["bits"].to_numpy()
    return out.view(np.uint8)


def _searched(kinds: list[Sizes], known_runs: np.ndarray, known_keys: np.ndarray):
    """Words of the documents that may hold an item, and the keys that say so."""

    def found(words: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at, key = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        n = len(words)
        end = np.repeat(ends, ends - begins)
        shared: dict[int, np.ndarray] = {}
        for kind in kinds:
            if kind.width not in shared:
                hit = np.zeros(n, bool)
                made = runs(words, kind.width)
                hit[: len(made)] = _has(known_runs, made)
                hit &= np.arange(n) + kind.width <= end
                shared[kind.width] = np.r_[0, np.cumsum(hit, dtype=np.int32)]
            many = shared[kind.width]
            if many[-1] < kind.need:
                continue
            stop = np.minimum(np.arange(n) + kind.reach, end) - kind.width + 1
            laid = np.flatnonzero(many[np.maximum(stop, 0)] - many[:-1] >= kind.need)
            for part in range(0, len(laid), 16 * AT_ONCE):
                start = laid[part : part + 16 * AT_ONCE]
                made = keys(words, start, end[start], kind)
                row, repeat = np.nonzero(_has(known_keys, made))
                at.append(start[row])
                key.append(made[row, repeat])
        return np.concatenate(at), np.concatenate(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text", 1 << 20):
                words, counts = sequences(piece.column("text").to_pylist())
                ends = np.cumsum(counts)
                begins = ends - counts
                at, key = found(words, begins, ends)
                if not len(at):
                    continue
                doc = np.searchsorted(ends, at, side="right")
                order = np.argsort(doc, kind="stable")
                at, key, doc = at[order], key[order], doc[order]
                which, first = np.unique(doc, return_index=True)
                hits = pa.StructArray.from_arrays([pa.array(key.view(np.int64)), pa.array(at - begins[doc])], names=["key", "p"])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("rid").take(pa.array(which)), piece.column("doc_id").take(pa.array(which)),
                     pa.array([words[begins[d] : ends[d]].view(np.int64) for d in which], pa.list_(pa.int64())),
                     pa.ListArray.from_arrays(pa.array(np.r_[first, len(at)].astype(np.int32)), hits)],
                    names=["rid", "doc_id", "words", "hits"],
                )

    return run


def _verified(tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for words, item, starts in zip(batch.column("words"), batch.column("item_words"), batch.column("starts").to_pylist(), strict=True):
                text, sought = words.values.to_numpy(), item.values.to_numpy()
                n = len(sought)
                k = int(tolerance * n + 1e-9)
                stretches: list[list[int]] = []
                for s in sorted(starts):
                    lo, hi = max(0, s - k), min(len(text), s + n + 2 * k)
                    if stretches and lo <= stretches[-1][1]:
                        stretches[-1][1] = max(stretches[-1][1], hi)
                    else:
                        stretches.append([lo, hi])
                least = min(edit_search(sought, text[lo:hi])[0] for lo, hi in stretches)
                best.append(least if least <= k else None)
            sizes = batch.column("item_words")
            made = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("item"), pa.array(best, pa.int32()), pa.array([len(x) for x in sizes], pa.int32())],
                names=["doc_id", "item", "edits", "item_words"],
            )
            yield made.filter(made.column("edits").is_valid())

    return run


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id, item_id, edits, item_words`` of every contaminated row of ``doc_id, text`` against ``item_id, text``."""
    kind = dict(docs.dtypes)["doc_id"]
    named = benchmark.where("text is not null").select("item_id", "text", F.unhex(F.md5("text")).alias("item"))
    texts = named.groupBy("item").agg(F.first("text").alias("text"))
    path = work_path(spark, "items")
    texts.mapInArrow(tidy(_items_read(tolerance)), "item binary, words array<long>, kinds array<int>, runs array<long>, probes array<struct<key:long,offset:long>>").write.parquet(path)
    items = spark.read.parquet(path)
    # At most as many rows as there are classes.
    kinds = [Sizes(r["k"], tolerance) for r in items.select(F.explode("kinds").alias("k")).distinct().orderBy("k").collect()]
    known_runs = _bitmap(items.select(F.explode("runs").alias("run")).distinct())
    probes = items.select("item", F.inline("probes"))
    known_keys = _bitmap(probes.select("key").distinct())
    # A text's places are those of the row it was read from, so the documents that go on are written once.
    path = work_path(spark, "near-items")
    numbered = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    numbered.mapInArrow(tidy(_searched(kinds, known_runs, known_keys)), f"rid long, doc_id {kind}, words array<long>, hits array<struct<key:long,p:long>>").write.parquet(path)
    near = spark.read.parquet(path)
    hits = near.select("rid", F.inline("hits"))
    total = near.agg(F.coalesce(F.sum(F.size("hits")), F.lit(0)).alias("n")).first()["n"]
    frequent = hot_keys(hits.groupBy("key").agg(F.count("*").alias("n")), "key", total)
    pairs = spread_join(hits, probes, "key", frequent).groupBy("rid", "item").agg(F.collect_set(F.col("p") - F.col("offset")).alias("starts"))
    pairs = cut(spark, pairs)
    n = pairs.count()
    by_item, by_row = (hot_keys(pairs.groupBy(c).agg(F.count("*").alias("n")), c, n) for c in ("item", "rid"))
    with_item = spread_join(pairs, items.select("item", F.col("words").alias("item_words")), "item", by_item)
    whole = spread_join(with_item, near.select("rid", "doc_id", "words"), "rid", by_row)
    found = whole.select("doc_id", "item", "words", "item_words", "starts").mapInArrow(tidy(_verified(tolerance)), f"doc_id {kind}, item binary, edits int, item_words int")
    return spread_join(found, named.select("item", "item_id"), "item", by_item).select("doc_id", "item_id", "edits", "item_words")


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with their columns; rows are judged by their text, not their id."""
    fp = free_name(docs, "_fp")
    marked = docs.withColumn(fp, F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")))))
    found = leaks(spark, marked.select(F.col(fp).alias("doc_id"), "text"), benchmark, tolerance).select(F.col("doc_id").alias(fp)).distinct()
    return marked.join(found, fp, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
