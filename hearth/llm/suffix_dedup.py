"""Removal of every byte covered by a string of ``length`` bytes that also starts elsewhere.

Strings are found in the Burrows-Wheeler transform of a collection that is built column by column.  Three steps
distribute it:

1. *Windows.*  Every string of ``length`` bytes is filed under its anchor, the ``gram``-byte substring with the least hash
   (the first of equal ones), so equal strings have equal anchors at equal offsets.  Consecutive starts with one anchor
   form a window (on average 70 starts).  Windows whose anchor occurs once in the corpus cannot repeat and are dropped.
2. *Collection.*  Equal windows are collapsed, keeping their number; one text that holds each gives its bytes, which are searched once
   however many rows repeat that text and its id.  The windows
   of an anchor are a collection of documents, aligned at the anchor.  From the last column to the first, one symbol of
   every document is inserted: the previous column's segment (documents in suffix order with their common prefixes
   and, as transform, the symbols before) is read in sequence, its documents are stably sorted by the inserted symbol, and
   the next segment with updated common prefixes is written.  Suffixes that start in different columns belong to different
   offsets from the anchor and cannot be equal strings, so every column keeps a segment of its own.  Where a
   common prefix with a neighbour reaches ``length``, the string repeats.  Segments are sequential; only the last one is
   held, and Spark's sorted shuffle is the external file that feeds them, so a task's memory is bounded by
   ``BATCH`` windows.
3. *Cutting.*  Covered intervals go back to all texts that hold the window; each text is cut once.

An anchor with more than ``HOT`` different windows is split: its strings are filed under themselves instead.

Defined cases: null counts as empty; texts shorter than ``length`` have nothing to remove; equal texts (repeated rows
too) remove all of each other; null ids are kept; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import cut, ship, slices, tidy, work_path
from hearth.llm.shingles import _BASE, _LETTER, mix

ship(__name__)

LENGTH, GRAM = 200, 64
PIECE = 1 << 20  # positions of a piece of text that is hashed at once
BATCH, HOT = 20_000, 20_000
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse."""
    size = 1 << max(10, (n - 1).bit_length())
    if size not in _powers:
        up, down = np.full(size, _BASE, np.uint64), np.full(size, _INVERSE, np.uint64)
        up[0] = down[0] = 1
        _powers[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers[size]


def windows(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Begin, number of starts, anchor offset, anchor hash and content hash of the windows of texts ending at ``ends``."""
    n = len(data)
    if n < length or n > PIECE:
        assert n < length, "pieces are at most PIECE long"
        none = np.zeros(0, np.int64)
        return none, none, none, none, none
    rolled, width, power = _LETTER[data], 1, _BASE
    while width < gram:
        rolled = rolled[:-width] * np.uint64(power) + rolled[width:]
        width, power = 2 * width, power * power & 0xFFFFFFFFFFFFFFFF
    rolled = mix(rolled)
    low = np.uint64(PIECE - 1)
    least = rolled & ~low | np.arange(len(rolled), dtype=np.uint64)
    span, wanted = 1, length - gram + 1
    while 2 * span <= wanted:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wanted:
        least = np.minimum(least[: span - wanted], least[wanted - span :])
    at = (least & low).astype(np.int64)
    doc = np.searchsorted(ends, np.arange(len(at)), side="right")
    inside = np.arange(len(at)) + length <= ends[doc]
    fresh = np.r_[True, (at[1:] != at[:-1]) | (inside[1:] != inside[:-1]) | (doc[1:] != doc[:-1])]
    begin = np.flatnonzero(fresh)
    count = np.diff(np.r_[begin, len(at)])
    begin, count = begin[inside[begin]], count[inside[begin]]
    up, down = _tables(n + 1)
    sums = np.r_[np.uint64(0), np.cumsum(mix(_LETTER[data]) * down[:n])]
    stop = begin + count + length - 1
    content = mix((sums[stop] - sums[begin]) * up[begin] + mix(count.astype(np.uint64)))
    return begin, count, at[begin] - begin, rolled[at[begin]].view(np.int64), content.view(np.int64)


def _pieces(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, text ends, text numbers, offset of each text's part); long texts in pieces that overlap by ``length`` - 1."""
    held, held_n = [], 0

    def made():
        return np.frombuffer(b"".join(p for _, _, p in held), np.uint8), np.cumsum([len(p) for _, _, p in held]), np.array([i for i, _, _ in held]), np.array([o for _, o, _ in held])

    for i, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - length + 1), PIECE - length + 1):
            part = text[offset : offset + PIECE]
            if held and held_n + len(part) > PIECE:
                yield made()
                held, held_n = [], 0
            held.append((i, offset, part))
            held_n += len(part)
    if held:
        yield made()


def _filed(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                times: dict[bytes, int] = {}
                bodies: dict[bytes, bytes] = {}
                for key, text in zip(part.column("txt").to_pylist(), part.column("text").to_pylist(), strict=True):
                    times[key] = times.get(key, 0) + 1
                    bodies.setdefault(key, text)
                keys = list(bodies)
                number = np.array(list(times.values()))
                for data, ends, who, offset in _pieces(list(bodies.values()), length):
                    begin, count, at, anchor, content = windows(data, ends, length, gram)
                    doc = np.searchsorted(ends, begin, side="right")
                    starts = begin - np.r_[0, ends[:-1]][doc] + offset[doc]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor), pa.array(content), pa.array(count.astype(np.int32)), pa.array(at.astype(np.int32)),
                         pa.array([keys[i] for i in who[doc]], pa.binary()), pa.array(starts), pa.array(number[who[doc]])],
                        names=["h", "x", "n", "a", "txt", "s", "times"],
                    )

    return run


def repeated_starts(groups: np.ndarray, strings: list[bytes], counts: np.ndarray, anchors: np.ndarray, times: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """(windows x offsets) whether the string at each start offset from the first aligned column repeats in its group.

    ``groups`` must be sorted.  Row i's start p is in column ``anchors.max() - anchors[i] + p``.
    """
    rows, ahead = len(strings), int(anchors.max())
    sizes = np.array([len(s) for s in strings])
    shift = ahead - anchors
    columns = int((shift + sizes).max())
    none = 256
    symbols = np.full((columns, rows), none, np.uint16)
    flat = np.frombuffer(b"".join(strings), np.uint8)
    row = np.repeat(np.arange(rows), sizes)
    symbols[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes - shift, sizes), row] = flat
    starts = np.zeros((rows, columns), bool)
    group = np.cumsum(np.r_[0, groups[1:] != groups[:-1]]) * 512
    # The segment of the column to the right: documents in suffix order, and their common prefix with the one before.
    order, common = np.arange(rows), np.zeros(rows + 1, np.int32)
    last_start = shift + counts - 1
    for c in range(columns - 1, -1, -1):
        inserted = group + symbols[c][order]  # documents of a group stay together, so ``group`` holds for any order
        if (inserted[1:] >= inserted[:-1]).all():
            place = None
            kept = inserted
            lowest = common[:rows]
        else:
            place = np.argsort(inserted, kind="stable")
            kept = inserted[place]
            before, here = np.r_[0, place[:-1]], place
            # Least common prefix over all documents passed between the two: their common prefix one column ahead.
            forward = here > before
            lowest = np.zeros(rows, np.int32)
            pairs = np.flatnonzero(forward)
            span = np.stack([before[pairs] + 1, here[pairs] + 1], axis=1).reshape(-1)
            if len(span):
                lowest[pairs] = np.minimum.reduceat(common, span)[::2]
            order = order[place]
        same = np.r_[False, kept[1:] == kept[:-1]] & (kept % 512 != none)
        common = np.r_[np.where(same, lowest + 1, 0), 0].astype(np.int32)
        if c <= last_start.max():
            long = common >= length
            found = long[:rows] | long[1:]
            mine = order
            ok = (c >= shift[mine]) & (c <= last_start[mine])
            starts[mine, c] = ok & (found | (times[mine] > 1))
    return starts


def _searched(length: int):
    def solved(rows: list[tuple]) -> pa.RecordBatch:
        h, x, n, a, times, strings = (list(c) for c in zip(*rows, strict=True))
        anchors = np.array(a)
        hit = repeated_starts(np.array(h), strings, np.array(n), anchors, np.array(times), length)
        edges = np.diff(np.pad(hit, ((0, 0), (1, 1))).view(np.int8), axis=1)
        row, begin = np.nonzero(edges == 1)
        _, end = np.nonzero(edges == -1)
        shift = anchors.max() - anchors[row]
        who = np.unique(row)
        bounds = np.searchsorted(row, who)
        flat = np.stack([begin - shift, end - shift + length - 1], axis=1).reshape(-1).astype(np.int32)
        spans = pa.ListArray.from_arrays(pa.array(np.r_[2 * bounds, 2 * len(row)].astype(np.int32)), pa.array(flat))
        pick = lambda v, t: pa.array([v[i] for i in who], t)
        return pa.RecordBatch.from_arrays([pick(h, pa.int64()), pick(x, pa.int64()), pick(n, pa.int32()), pick(a, pa.int32()), spans], names=["h", "x", "n", "a", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        last = None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("h", "x", "n", "a", "times", "body")]
            for row in zip(*columns, strict=True):
                if row[:4] == last:  # rows that repeat id and text (or have no id) all give the window's bytes: once is enough
                    continue
                last = row[:4]
                if len(held) >= BATCH and held[-1][0] != row[0]:
                    yield solved(held)
                    held = []
                held.append(row)
        if held:
            yield solved(held)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist(), strict=True):
            body = text.as_py()
            gone = _merged(sorted((s[i], s[i + 1]) for s in spans or () for i in range(0, len(s), 2)))
            kept, free = hashlib.sha256(), 0
            for b, e in gone:
                kept.update(body[free:b])
                free = e
            kept.update(body[free:])
            out.append((len(body), sum(e - b for b, e in gone), len(gone), kept.hexdigest(), gone))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())))))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"],
        )


def _merged(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in parts:
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((b, e))
    return out


def dedup(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed`` of every row of ``doc_id, text``; ``removed`` lists byte ranges."""
    kind = dict(docs.dtypes)["doc_id"]
    body = F.coalesce(F.col("text"), F.lit(""))
    # Both joins below shuffle just these columns of just these rows by ``txt``, so Spark shuffles the texts once.
    texts = docs.select("doc_id", F.unhex(F.md5(body)).alias("txt"), body.cast("binary").alias("text")).where(F.col("txt").isNotNull())
    filed = texts.where(F.length("text") >= length).select("txt", "text").mapInArrow(tidy(_filed(length, gram)), "h long, x long, n int, a int, txt binary, s long, times long")
    # A table of its own, so that the join below may split a hot anchor.
    often = cut(spark, filed.groupBy("h").agg(F.sum("times").alias("all")).where(F.col("all") > 1).select("h"))
    # Only windows whose anchor repeats go on, as a table in the shared folder (it is read twice and cuts the lineage).
    path = work_path(spark, "windows")
    filed.join(often, "h").write.option("compression", "zstd").parquet(path)
    held = spark.read.parquet(path)
    key = ["h", "x", "n", "a"]
    unique = held.groupBy(*key).agg(F.sum("times").alias("times"), F.min(F.struct("txt", "s")).alias("rep")).select(*key, "times", "rep.*")
    first_id = texts.groupBy(F.col("txt").alias("t")).agg(F.min("doc_id").alias("one"))
    named = unique.join(first_id, unique["txt"] == F.col("t")).select(*key, "times", "t", "s", "one")
    one_row = F.xxhash64("one").bitwiseXOR(F.xxhash64("doc_id")) == 0  # not an equality Spark would add to the join's keys
    bodies = (
        texts.join(named, (texts["txt"] == named["t"]) & one_row)
        .select(*key, "times", F.expr("substring(text, cast(s + 1 as int), n + %d)" % (length - 1)).alias("body"))
    )
    crowded = unique.groupBy("h").count().where(F.col("count") > hot).select("h")
    spans_of = lambda rows: rows.repartition("h").sortWithinPartitions(*key).mapInArrow(tidy(_searched(length)), "h long, x long, n int, a int, spans array<int>")
    if crowded.isEmpty():
        found = spans_of(bodies)
    else:
        path = work_path(spark, "bodies")
        bodies.dropDuplicates(key).write.option("compression", "zstd").parquet(path)
        bodies = spark.read.parquet(path)
        calm = spans_of(bodies.join(crowded, "h", "left_anti"))
        each = bodies.join(crowded, "h", "left_semi").select(*key, "times", F.posexplode(F.expr("transform(sequence(1, n), i -> substring(body, i, %d))" % length)).alias("p", "string"))
        alone = each.groupBy("string").agg(F.sum("times").alias("times")).select(
            F.xxhash64("string").alias("h"), F.xxhash64("string", F.lit(1)).alias("x"), F.lit(1).alias("n"), F.lit(0).alias("a"), "times", F.col("string").alias("body")
        )
        split = spans_of(alone).select(F.col("h").alias("sh"), F.col("x").alias("sx"))
        keyed = each.select(*key, "p", F.xxhash64("string").alias("sh"), F.xxhash64("string", F.lit(1)).alias("sx"))
        warm = keyed.join(split, ["sh", "sx"]).groupBy(*key).agg(F.flatten(F.collect_list(F.array(F.col("p"), F.col("p") + length))).alias("spans"))
        found = calm.unionByName(warm)
    back = held.select(*key, "txt", "s").distinct().join(found, key)
    spans = back.groupBy("txt").agg(F.collect_list(F.transform("spans", lambda v: v + F.col("s"))).alias("spans"))
    whole = texts.join(spans, "txt", "left").select("doc_id", "text", "spans")
    return whole.mapInArrow(tidy(_cut), f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<array<long>>")
