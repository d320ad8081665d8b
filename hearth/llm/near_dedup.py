"""Near-duplicate classes by DartMinHash signatures, banding and exact verification.

A text is a multiset of word shingles; a shingle that occurs c times is an element of weight c.  Each unit of weight of an
element is a region in which hashed darts arrive along a rank axis as a Poisson process (their gaps are exponential
numbers drawn from the element's hash).  All darts below a rank bound are thrown, the bound being set so that about
``k ln k + 2k`` land whatever the total weight; each dart names a coordinate, and the earliest dart of each coordinate is
kept.  Where coordinates stay empty the bound is doubled.  Two texts agree in a coordinate with the probability of
their weighted Jaccard similarity (sum of minima by sum of maxima).

Bands of rows of the signature form buckets.  Texts that are equal are collapsed first.  In a bucket every text is
compared with its head, the text that shares most buckets with others; a pair is a link if its exact similarity reaches
the threshold.  Where the links leave a bucket in several components, its texts outside the largest are compared with all
of the others: in small buckets by pairs, but for those that the triangle inequality of the Jaccard distance (through the
head) rules out; in larger ones in blocks: a block of texts outside the largest component and a block of any texts of the bucket
meet in a task, which counts common shingles over an inverted index and emits one link for each text and other component.
Classes are the connected components of the links.
So no pair that shares a bucket is lost from the classes, while a large group of near copies, once its head has linked it,
costs one comparison a text and band and not all its pairs.  Hot buckets, heads, hubs, classes and copied texts are dealt over
several tasks (``common.spread_join``).

At the defaults (28 bands of 6 rows) a pair at similarity 0.8 shares a bucket with probability 0.9998.

Defined cases: null and empty texts and texts without words are equal only to the same text (null counts as empty); the class id is the
least non-null ``doc_id`` of the class, null if all are null; different texts with the same id stay in their own classes (``root``); ties and repeated rows fall in one class; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.llm.common import cut, free_name, hot_keys, ship, slices, spread_join, tidy
from hearth.llm.graph import components
from hearth.llm.shingles import mix, shingle_hashes

ship(__name__)

WIDTH, THRESHOLD = 5, 0.8
BANDS, ROWS = 28, 6
SMALL, BLOCK = 32, 256  # texts of a bucket whose pairs are laid out as rows; texts of a block of a larger one


def weighted(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each unit of weight (the c-th occurrence of an element in its text has its own), and its text."""
    doc = np.repeat(np.arange(len(counts)), counts)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    fresh = np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])] if len(h) else np.zeros(0, bool)
    starts = np.flatnonzero(fresh)
    nth = np.arange(len(h)) - np.repeat(starts, np.diff(np.r_[starts, len(h)]))
    return mix(h + nth.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), d


def signatures(hashes: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """(texts x k) identities of the earliest dart of each coordinate; texts without elements have zeros."""
    n = len(counts)
    out, lowest = np.zeros(n * k, np.uint64), np.full(n * k, np.inf)
    units, doc = weighted(hashes, counts)
    bound = (k * np.log(k) + 2 * k) / np.maximum(counts, 1)
    todo = counts > 0
    while todo.any():
        mine = todo[doc]
        state, owner = units[mine], doc[mine]
        rank = np.zeros(len(state))
        while len(state):
            # One more dart of every unit whose last one lay within its text's bound.
            state = mix(state + np.uint64(0x9E3779B97F4A7C15))
            rank = rank - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            inside = rank < bound[owner]
            rank, state, owner = rank[inside], state[inside], owner[inside]
            dart = mix(state ^ np.uint64(0xA5A5A5A55A5A5A5A))
            cell = owner * k + (dart % np.uint64(k)).astype(np.int64)
            better = np.flatnonzero(rank < lowest[cell])
            better = better[np.argsort(-rank[better], kind="stable")]
            lowest[cell[better]] = rank[better]  # of several darts in a cell the last one written is the earliest
            out[cell[better]] = dart[better]
        todo &= np.isinf(lowest.reshape(n, k)).any(axis=1)
        bound[todo] *= 2
    return out.reshape(n, k)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """(texts x bands) int64 bucket keys; the band's number is part of the key."""
    key = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(signature), axis=0)
    parts = signature.reshape(len(signature), bands, rows)
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def _signed(width: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                hashes, counts = shingle_hashes(part.column("text").to_pylist(), width)
                keys = band_keys(signatures(hashes, counts, bands * rows), bands, rows)
                offsets = np.r_[0, np.cumsum(np.where(counts > 0, bands, 0))].astype(np.int32)
                flat = keys[counts > 0].reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("fp"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=["doc_id", "fp", "keys"]
                )

    return run


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two (sorted hashes, counts)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    either = float(a[1].sum() + b[1].sum()) - both
    return both / either if either else 1.0


def _compared(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            out = []
            for a, ta, tb in zip(batch.column("a").to_pylist(), batch.column("ta"), batch.column("tb"), strict=True):
                if a != last:
                    last, held = a, np.unique(shingle_hashes([ta.as_py()], width)[0], return_counts=True)
                out.append(similarity(held, np.unique(shingle_hashes([tb.as_py()], width)[0], return_counts=True)))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.float64())], names=["a", "b", "sim"])

    return run


def one_text_each(texts: DataFrame, firsts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``fp, text`` of the wanted ``fp``, from ``doc_id, fp, text``.

    Rows meet by text and id, ``firsts`` naming the id to take, so that the copies of one text are dealt over many tasks.
    """
    named = firsts.join(wanted, "fp", "left_semi").select(F.col("fp").alias("f"), "first_id")
    same = (F.col("fp") == F.col("f")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    return texts.join(named, same, "left_semi").select("fp", "text").dropDuplicates(["fp"])


def compare(pairs: DataFrame, texts: DataFrame, firsts: DataFrame, width: int, total: int) -> DataFrame:
    """``a, b, sim`` of at most ``total`` distinct pairs; a text that heads many pairs is copied to several tasks."""
    kept = one_text_each(texts, firsts, pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct())
    one = kept.select(F.col("fp").alias("a"), F.col("text").alias("ta"))
    two = kept.select(F.col("fp").alias("b"), F.col("text").alias("tb"))
    headed = spread_join(pairs.select("a", "b"), one, "a", hot_keys(pairs.groupBy("a").agg(F.count("*").alias("n")), "a", total))
    return headed.join(two, "b").select("a", "b", "ta", "tb").mapInArrow(tidy(_compared(width)), "a binary, b binary, sim double")


def _block_links(width: int, threshold: float):
    """Links from the open texts of a block to the texts of another block of one bucket, one for each text and other component."""

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        opened = [i for i, r in enumerate(rows) if r[4]]
        number = {r[2]: i for i, r in enumerate(rows)}
        root = np.array([number[r[2]] for r in rows])
        out = []
        if opened and len(number) > 1:
            hashes, counts = shingle_hashes([r[3] for r in rows], width)
            units, owner = weighted(hashes, counts)
            order = np.argsort(units, kind="stable")
            units, owner = units[order], owner[order]
            start = np.flatnonzero(np.r_[True, units[1:] != units[:-1]])
            group = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(units)]))
            stop = np.r_[start[1:], len(units)]
            mine = np.argsort(owner, kind="stable")
            bounds = np.r_[0, np.cumsum(counts)]
            for i in opened:
                g = group[mine[bounds[i] : bounds[i + 1]]]
                n = stop[g] - start[g]
                posted = owner[np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[g], n)]
                both = np.bincount(posted, minlength=len(rows))
                near = np.flatnonzero((both >= threshold * (counts[i] + counts - both)) & (root != root[i]))
                _, first = np.unique(root[near], return_index=True)
                out += [(rows[i][1], rows[j][1]) for j in near[first].tolist()]
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.binary()) for k in (0, 1)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("pair", "b", "root", "text", "opened")), strict=True):
                if held and held[-1][0] != row[0]:
                    yield solved(held)
                    held = []
                held.append(row)
        if held:
            yield solved(held)

    return run


def classes(
    spark: SparkSession, docs: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``doc_id, class_id, fp, root`` of every row of ``doc_id, text``.

    ``fp`` is the text's own identity (md5), ``root`` that of the class: different classes have different roots, while they share a
    ``class_id`` where texts of different classes have the same least id.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("fp", F.unhex(F.md5("text")))
    kind = dict(docs.dtypes)["doc_id"]
    signed = cut(spark, texts.mapInArrow(tidy(_signed(width, bands, rows)), f"doc_id {kind}, fp binary, keys array<long>"))
    total = signed.count()
    distinct = cut(spark, signed.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.first("keys").alias("keys"), F.count("*").alias("n")))
    firsts = distinct.select("fp", "first_id")
    spots = distinct.select(F.explode("keys").alias("key"), F.col("fp").alias("b"))
    shared = cut(spark, spots.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    buckets = hot_keys(shared, "key", total * bands)
    met = cut(spark, spread_join(spots, shared, "key", buckets))
    # A bucket's head is the text that meets most others over all its buckets: the middle of a group of near copies.
    ranked = met.join(met.groupBy("b").agg(F.sum("n").alias("meets")), "b")
    heads = ranked.groupBy("key").agg(F.max(F.struct("meets", "b"))["b"].alias("a"))
    members = cut(spark, spread_join(met, heads, "key", buckets))
    headed = cut(spark, members.where("a <> b").select("a", "b").distinct())
    first = cut(spark, compare(headed, texts, firsts, width, headed.count()))
    links = first.where(F.col("sim") >= threshold).select("a", "b")
    roots = cut(spark, components(spark, links))
    # Buckets that still span several components.
    placed = (
        members.join(first, ["a", "b"], "left").join(roots.withColumnRenamed("node", "b"), "b", "left")
        .select("key", "n", "b", F.coalesce("sim", F.lit(1.0)).alias("sim"), F.coalesce("root", "b").alias("root"))
    )
    split = placed.where("n > 2").groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("key")
    open_ = cut(spark, spread_join(placed, split, "key", buckets))
    # Small ones: pairs between components, but for those that the triangle inequality excludes.
    small = open_.where(F.col("n") <= SMALL)
    x, y = small.alias("x"), small.alias("y")
    near = (F.col("x.root") != F.col("y.root")) & (F.col("x.b") < F.col("y.b")) & (F.abs(F.col("x.sim") - F.col("y.sim")) <= 1 - threshold)
    rest = x.join(y, (F.col("x.key") == F.col("y.key")) & near).where("x.sim < 1 and y.sim < 1").select(F.col("x.b").alias("a"), F.col("y.b").alias("b")).distinct()
    untried = cut(spark, rest.join(first, ["a", "b"], "left_anti"))
    second = compare(untried, texts, firsts, width, untried.count()).where(F.col("sim") >= threshold).select("a", "b")
    # Large ones: the texts outside the largest component, in blocks, meet the blocks of all texts; only links leave the task.
    big = open_.where(F.col("n") > SMALL)
    sizes = big.groupBy("key", "root").agg(F.count("*").alias("m"))
    largest = sizes.groupBy("key").agg(F.max(F.struct("m", "root"))["root"].alias("top"), (F.sum("m") - F.max("m")).alias("outside"), F.sum("m").alias("n"))
    marked = spread_join(big.select("key", "b", "root"), largest, "key", buckets)
    every, some = F.ceil(F.col("n") / BLOCK).cast("int"), F.ceil(F.col("outside") / BLOCK).cast("int")
    pair = lambda i, j: F.concat_ws(":", F.col("key"), i, j)
    left = marked.where("root <> top").withColumn("i", F.pmod(F.xxhash64("b"), some)).select(
        F.explode(F.transform(F.sequence(F.lit(0), every - 1), lambda j: pair(F.col("i"), j))).alias("pair"), "b", "root", F.lit(True).alias("opened")
    )
    right = marked.withColumn("j", F.pmod(F.xxhash64("b"), every)).select(
        F.explode(F.transform(F.sequence(F.lit(0), some - 1), lambda i: pair(i, F.col("j")))).alias("pair"), "b", "root", F.lit(False).alias("opened")
    )
    held = one_text_each(texts, firsts, big.select(F.col("b").alias("fp")).distinct()).withColumnRenamed("fp", "b")
    met_blocks = left.unionByName(right).groupBy("pair", "b", "root").agg(F.max("opened").alias("opened"))
    third = met_blocks.join(held, "b").repartition("pair").sortWithinPartitions("pair", "b").mapInArrow(tidy(_block_links(width, threshold)), "a binary, b binary")
    more = cut(spark, second.unionByName(third).distinct())
    final = roots if more.isEmpty() else components(spark, links.unionByName(more))
    named = distinct.select("fp", "first_id").join(final.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = cut(spark, named)
    by_class = ids.groupBy("root").agg(F.min("first_id").alias("class_id"), F.count("*").alias("n"))
    by_text = spread_join(ids.select("fp", "root"), by_class.select("root", "class_id"), "root", hot_keys(by_class, "root", total))
    return spread_join(signed.select("doc_id", "fp"), by_text, "fp", hot_keys(distinct.select("fp", "n"), "fp", total)).select("doc_id", "class_id", "fp", "root")


def keep_one(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each class: the first by (doc_id, text); columns are kept as they are."""
    found = classes(spark, docs, **options)
    name = lambda doc_id, fp: F.unhex(F.md5(F.concat_ws(":", F.hex(fp), F.coalesce(doc_id.cast("string"), F.lit("null")))))
    best = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")).alias("k"))
    row = free_name(docs, "_row")
    kept = best.select(name(F.col("k.doc_id"), F.col("k.fp")).alias(row))
    marked = docs.withColumn(row, name(F.col("doc_id"), F.unhex(F.md5(F.coalesce(F.col("text"), F.lit(""))))))
    # Rows that repeat id and text are one document.
    return marked.join(kept, row, "left_semi").dropDuplicates([row]).select(*[F.col(f"`{c}`") for c in docs.columns])
