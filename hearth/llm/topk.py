"""Exact top-k by inner product with block-at-a-time pruning.

1. *Document ranges.*  Vectors are put into an order in which near ones stand together: by the nearest of at most ``PIVOTS`` vectors
   (a bounded sample, the first by a hash of their id), then by the second nearest and the distance.  The vectors of a pivot
   form shards of about ``SHARD_ROWS``, cut into ranges of ``BLOCK`` rows.  A range is one row of a table: its ids, its forward
   index (the vectors) and the maximum and, as components may be negative, the minimum of each term.
2. *First scores.*  Every query is scored in one shard, that of its own pivot.  Its k-th score there bounds its result from below.
3. *Bounds before data.*  The bound of a shard or range for a query is the sum over the terms of the larger product.  Queries
   meet the shards' maxima, in blocks, and go on only to shards whose bound reaches their k-th score.
4. *Block at a time.*  In a shard, a query visits the ranges by falling bound, scores them through their forward index, and
   stops when the next bound falls below its k-th score so far.  The k rows of each query and shard are merged by rank.

A shard meets its queries in chunks of about ``CHUNK_ROWS``, so no task holds more than one shard and one chunk; a shard that no
query can need is not read again.  Vectors that are spread evenly in many dimensions have bounds that prune nothing; all
pairs are scored then, in blocks.

Scores are exact integers: sums run in float64 while every partial sum is below 2**53, else in Python integers without pruning.

Defined cases: vectors that are null, or hold null or non-finite components, and null ids take no part; vectors of other
lengths than the query's are no candidates; repeated ids are one query but all candidates for others; ties go to the
smaller id; an empty table gives an empty result; fewer than k candidates give all of them; a score beyond the range of a
long ranks by its exact value and is given as the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearth.llm.common import cut, ship, work_path

ship(__name__)

SHARD_ROWS, CHUNK_ROWS, BLOCK = 8192, 2048, 64
PIVOTS, PIECE_ROWS = 1024, 8192  # pivots; shards whose maxima meet a chunk of queries together
_LONG = np.iinfo(np.int64)
_FOUND = "query_id long, vec_id long, score long, exact string, shard long, scored long"


def quantised(embedding: Column, scale: int = 1024) -> Column:
    """``floor(scale * x)`` of each component, as whole doubles; null where the vector takes no part."""
    usable = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))

    def floor(x: Column) -> Column:
        y = F.greatest(F.least(x.cast("double") * float(scale), F.lit(1.7976931348623157e308)), F.lit(-1.7976931348623157e308))
        return F.rint(y) - (F.rint(y) > y).cast("double") + F.lit(0.0)

    return F.when(embedding.isNotNull() & usable, F.transform(embedding, floor))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of a list column of one length."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(whole), -1)


def _most(a: np.ndarray, b: np.ndarray) -> float:
    """No sum of products of rows of a and b is larger in size."""
    return float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])


def _whole(rows: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in r] for r in rows], dtype=object).reshape(rows.shape)


def _bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """No smaller than any product of the query with a row of the range."""
    if max(_most(queries, high), _most(queries, low)) >= 2.0**53:
        return np.full((len(queries), len(high)), np.inf)
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def search_shard(
    q_ids: np.ndarray, queries: np.ndarray, least: np.ndarray, ids: list[np.ndarray], rows: list[np.ndarray], high: np.ndarray, low: np.ndarray, k: int
) -> Iterator[tuple[int, list[int], list[int], int]]:
    """(query id, vector ids, scores, rows scored) of the k best rows of one shard with scores of ``least`` at least.

    ``ids`` and ``rows`` are those of each range; a query's own id is left out.
    """
    flat = np.concatenate(rows)
    if _most(queries, flat) >= 2.0**53:
        exact, every = _whole(flat), np.concatenate(ids)
        for i, q in enumerate(_whole(queries)):
            best = sorted((-s, j) for s, j in zip((exact @ q).tolist(), every.tolist(), strict=True) if j != q_ids[i])[:k]
            yield int(q_ids[i]), [j for _, j in best], [-s for s, _ in best], len(every)
        return
    bounds = _bounds(queries, high, low)
    visits = np.argsort(-bounds, axis=1, kind="stable")
    n, last = len(queries), _LONG.max
    best_s, best_i, scored = np.full((n, k), -np.inf), np.full((n, k), last), np.zeros(n, np.int64)
    active = np.arange(n)
    for step in range(len(rows)):
        # Ties must still be seen: a range whose bound equals the k-th score may hold a smaller id.
        reached = np.maximum(best_s[active, k - 1], least[active])
        active = active[bounds[active, visits[active, step]] >= reached]
        if not len(active):
            break
        nxt = visits[active, step]
        by_range = np.argsort(nxt, kind="stable")
        edges = np.flatnonzero(np.r_[True, np.diff(nxt[by_range]) != 0, True])
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            who, block = active[by_range[a:b]], int(nxt[by_range[a]])
            scores = queries[who] @ rows[block].T
            cand = np.broadcast_to(ids[block], scores.shape)
            own = cand == q_ids[who][:, None]
            all_s = np.concatenate([best_s[who], np.where(own, -np.inf, scores)], axis=1)
            all_i = np.concatenate([best_i[who], np.where(own, last, cand)], axis=1)
            keep = np.lexsort((all_i, -all_s), axis=1)[:, :k]
            best_s[who], best_i[who] = np.take_along_axis(all_s, keep, 1), np.take_along_axis(all_i, keep, 1)
            scored[who] += len(ids[block])
    for j in range(n):
        real = best_s[j] > -np.inf
        yield int(q_ids[j]), best_i[j][real].tolist(), [int(s) for s in best_s[j][real]], int(scored[j])


def _placed(pivots: dict[int, np.ndarray]):
    """Nearest pivot of each vector (-1: none of its length), and its place among the pivot's vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            pivot, second, far = np.full(len(dims), -1), np.zeros(len(dims), np.int64), np.zeros(len(dims))
            for dim in np.unique(dims).tolist():
                if dim in pivots:
                    at = np.flatnonzero(dims == dim)
                    x, p = _matrix(batch.column("v").take(pa.array(at))), pivots[dim]
                    most = max(1.0, np.abs(x).max(initial=0), np.abs(p).max(initial=0))  # one scale for all: no square overflows
                    x, p = x / most, p / most
                    away = (p * p).sum(axis=1)[None, :] - 2 * x @ p.T
                    order = np.argsort(away, axis=1, kind="stable")
                    pivot[at], second[at] = order[:, 0], order[:, min(1, len(p) - 1)]
                    far[at] = away[np.arange(len(at)), order[:, 0]]
            columns = [batch.column("vec_id"), batch.column("v"), batch.column("dim"), pa.array(pivot), pa.array(second), pa.array(far)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "v", "dim", "pivot", "second", "far"])

    return run


def _ranges(block: int):
    """Rows sorted by (dim, shard) as ranges of at most ``block`` rows."""

    def made(rows: list[tuple]) -> pa.RecordBatch:
        v = np.array([r[3] for r in rows], np.float64).reshape(len(rows), -1)
        return pa.RecordBatch.from_arrays(
            [pa.array([rows[0][0]], pa.int32()), pa.array([rows[0][1]], pa.int64()), pa.array([[r[2] for r in rows]], pa.list_(pa.int64())),
             *(pa.array([x], pa.list_(pa.float64())) for x in (v.reshape(-1), v.max(axis=0), v.min(axis=0)))],
            names=["dim", "shard", "ids", "v", "high", "low"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("dim", "shard", "vec_id", "v")), strict=True):
                if held and (len(held) == block or held[-1][:2] != row[:2]):
                    yield made(held)
                    held = []
                held.append(row)
        if held:
            yield made(held)

    return run


def _scored(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            dim, shard = left["dim"][0].as_py(), left["shard"][0].as_py()
            ids = [np.array(x, np.int64) for x in left["ids"].to_pylist()]
            rows = [np.array(x, np.float64).reshape(-1, dim) for x in left["v"].to_pylist()]
            least = right["least"].to_numpy().astype(np.float64)
            found = search_shard(right["query_id"].to_numpy(), _matrix(right["v"]), np.where(np.isnan(least), -np.inf, least), ids, rows, _matrix(left["high"]), _matrix(left["low"]), k)
            for query, best, scores, n in found:
                out.append((query, None, None, None, shard, n))
                for i, s in zip(best, scores, strict=True):
                    small = min(max(s, _LONG.min), _LONG.max)
                    out.append((query, i, small, None if s == small else str(s), shard, 0))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
        names = [f.split()[0] for f in _FOUND.split(", ")]
        return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(names, types, strict=True))})

    return run


def _passing(left: pa.Table, right: pa.Table) -> pa.Table:
    """(query, shard) whose bound reaches the query's k-th score, but for the shard it has been scored in."""
    out = (np.zeros(0, np.int64),) * 2
    if left.num_rows and right.num_rows:
        bounds = _bounds(_matrix(right["v"]), _matrix(left["high"]), _matrix(left["low"]))
        least, shard = right["least"].to_numpy().astype(np.float64), left["shard"].to_numpy()
        ok = (bounds >= np.where(np.isnan(least), -np.inf, least)[:, None]) & (shard[None, :] != right["shard"].to_numpy()[:, None])
        row, column = np.nonzero(ok)
        out = right["query_id"].to_numpy()[row], shard[column]
    return pa.table({"query_id": pa.array(out[0]), "shard": pa.array(out[1])})


def _summed(ranges: pa.Table) -> pa.Table:
    high, low = _matrix(ranges["high"]).max(axis=0), _matrix(ranges["low"]).min(axis=0)
    return pa.table({"dim": ranges["dim"][:1], "shard": ranges["shard"][:1], "high": pa.array([high], pa.list_(pa.float64())), "low": pa.array([low], pa.list_(pa.float64()))})


def _meet(ranges: DataFrame, asked: DataFrame, k: int, chunk_rows: int) -> DataFrame:
    """Scores of ``query_id, v, least, dim, shard`` in their shards; shards with many queries meet them in chunks."""
    key = ["dim", "shard"]
    chunks = asked.groupBy(*key).agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks"))
    left = ranges.join(chunks, key).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    right = asked.join(chunks, key).withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int")).drop("chunks")
    key = [*key, "chunk"]
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_scored(k), _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query; ``exact`` holds scores beyond a long, which come before or after all others."""
    # Whole numbers as text: longer ones are larger in size.
    size = F.when(F.col("score") < 0, -F.length("exact")).otherwise(F.length("exact"))
    tail = F.when(F.col("score") > 0, F.col("exact"))
    head = F.when(F.col("score") < 0, F.col("exact"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc_nulls_last(size), F.desc_nulls_last(tail), F.asc_nulls_last(head), F.asc("vec_id"))
    return found.where("vec_id is not null").select("*", F.row_number().over(ranked).alias("rank")).where(F.col("rank") <= k)


def parts(
    spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS, chunk_rows: int = CHUNK_ROWS, block: int = BLOCK
) -> DataFrame:
    """Best rows of each query and shard that can hold some, and a row without ``vec_id`` with the number of rows ``scored``."""
    shown = lambda df: df.where("vec_id is not null and v is not null").select("vec_id", F.col("v").cast("array<double>").alias("v"), F.size("v").alias("dim"))
    rows = shown(vectors)
    total = rows.count()
    wanted = min(PIVOTS, -(-total // shard_rows))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(r["dim"], []).append(r["v"])
    pivots = {d: np.array(v, np.float64).reshape(len(v), d) for d, v in by_dim.items()}
    place = _placed(pivots)
    schema = "vec_id long, v array<double>, dim int, pivot long, second long, far double"
    # At most a row for each pivot.
    placed = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "v", "dim").mapInArrow(place, schema)
    sizes = {(r["dim"], r["pivot"]): -(-r["n"] // shard_rows) for r in placed.where("pivot >= 0").groupBy("dim", "pivot").agg(F.count("*").alias("n")).collect()}
    several = {f"{d}:{p}": n for (d, p), n in sizes.items() if n > 1}
    known = F.create_map(*(F.lit(x) for pair in several.items() for x in pair)) if several else F.create_map(F.lit(""), F.lit(1))
    split = F.coalesce(F.try_element_at(known, F.concat_ws(":", "dim", "pivot")), F.lit(1))
    shard = (F.col("pivot") * (1 << 32) + F.pmod(F.xxhash64("vec_id"), split)).alias("shard")
    path = work_path(spark, "ranges")
    ordered = placed.withColumn("shard", shard).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "second", "far", "vec_id")
    ordered.select("dim", "shard", "vec_id", "v").mapInArrow(_ranges(block), "dim int, shard long, ids array<long>, v array<double>, high array<double>, low array<double>").write.parquet(path)
    ranges = spark.read.parquet(path)
    asked = shown(queries).select(F.col("vec_id").cast("long").alias("vec_id"), "v", "dim").dropDuplicates(["vec_id"]).mapInArrow(place, schema)
    asked = cut(spark, asked.withColumn("shard", shard).select(F.col("vec_id").alias("query_id"), "v", "dim", "shard"))
    first = cut(spark, _meet(ranges, asked.withColumn("least", F.lit(None).cast("double")), k, chunk_rows))
    # A lower bound, as a double: a score beyond 2**53 is rounded, so it is taken a little lower.
    kth = _best(first, k).where(F.col("rank") == k).select("query_id", (F.col("score").cast("double") - F.abs(F.col("score").cast("double")) * 1e-15).alias("least"))
    bounded = asked.join(kth, "query_id", "left")
    maxima = cut(spark, ranges.select("dim", "shard", "high", "low").groupBy("dim", "shard").applyInArrow(_summed, "dim int, shard long, high array<double>, low array<double>"))
    pieces, chunks = max(1, -(-maxima.count() // PIECE_ROWS)), max(1, -(-asked.count() // chunk_rows))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = maxima.withColumn("piece", F.pmod(F.xxhash64("shard"), F.lit(pieces)).cast("int")).withColumn("chunk", every(chunks))
    right = bounded.withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)).cast("int")).withColumn("piece", every(pieces))
    key = ["dim", "piece", "chunk"]
    to_see = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_passing, "query_id long, shard long")
    rest = to_see.join(bounded.drop("shard"), "query_id")
    return first.unionByName(_meet(ranges, rest, k, chunk_rows))


def top_k(spark: SparkSession, vectors: DataFrame, queries: DataFrame, k: int = 10, **options) -> DataFrame:
    """``query_id, rank, vec_id, score`` from rows of ``vec_id, v`` (whole numbers) on both sides."""
    return _best(parts(spark, vectors, queries, k, **options), k).select("query_id", "rank", "vec_id", "score")
