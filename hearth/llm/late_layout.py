"""Late-arrival partition overwrite: a sorted day layout with exact cuts, and the rewriting of the days that late rows touch.

A *layout* of a table keeps the latest-arrived row of each key, and cuts each day, sorted by (time, key), into files of a given
number of rows (the last of a day perhaps fewer), at ``<day>/<file_no>/`` below its folder.

*Cuts.*  The first row of a file is an order statistic of its day: every ``rows``-th by (time, key).  They are found exactly, in rounds:
each open bracket (a range of times, or of keys of one time, in which wanted ranks lie) is counted by ``BINS`` equal bins, in
which each task counts its own rows before Spark adds the counts up; the bins that hold wanted ranks are the brackets of
the next round, tightened to the times and keys that occur in them, until a bracket is one row.  A day has a cut only
where it has more than ``rows`` rows, so brackets and cuts together are at most (all rows / ``rows``), a number that the caller fixes
whatever the size of the table; they alone come to the driver and go to the tasks.

*Routing.*  A row's file is the number of its day's cuts at or below it, by binary search; Spark shuffles rows by (day, file),
sorts each task's share and writes it.  No day and no key is gathered; a hot key meets in partial maxima first.

*Late rows.*  Rows that arrived at the limit or later (or at no known time) are late.  A late row that is kept touches its own day, and
the day in which its key's row stood before.  These days are laid out anew from all kept rows and replace what was there; other files are
not opened.  An executor lost on the way costs its tasks only, as Spark commits a day's files when its job ends.

Defined cases: rows without a time are day -1, before all other rows of that day; a null key is one key of its own, before others; a
row without an arrival is late, and older than any with one; of equally late rows of a key the greatest by the table's
columns, in their order, is kept, so that repeated rows count once; further columns are written like the others, whatever their
names (they must be of types that Spark can order); an empty table gives no file.  The least 64-bit integer is not used as a key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType, TimestampType

from hearth.llm.common import free_name, ship, tidy
from hearth.sources import paths

ship(__name__)

BINS = 256
MOST = 1 << 19  # rows and counts that a task holds before it adds them up
NOTHING = -(2**63)
DAY_MICROS = 86_400_000_000


def micros(rows: DataFrame, column: str) -> Column:
    """Microseconds since 1970 of a time with or without a zone, whatever the session's zone (a time without one is UTC)."""
    c = F.col(f"`{column}`")
    if isinstance(rows.schema[column].dataType, TimestampType):
        return F.unix_micros(c)
    whole = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
    return whole * 1_000_000 + (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("long")


def day_of(at: Column) -> Column:
    """Whole days since 1970, -1 for none."""
    return F.coalesce(((at - F.pmod(at, F.lit(DAY_MICROS))) / DAY_MICROS).cast("long"), F.lit(-1).cast("long"))


def kept_rows(rows: DataFrame, key: str, arrival: str, limit: int) -> DataFrame:
    """The rows that stand in the layout of the early rows or in that of all: the row as ``r``, ``start`` and ``final``.

    One shuffle by key, with the greatest row of each key and task before it.
    """
    rest = [F.col(f"`{c}`") for c in rows.columns if c != arrival]
    row = F.struct(F.col(f"`{arrival}`"), *rest)
    early = F.coalesce(micros(rows, arrival) < limit, F.lit(False))
    best = rows.groupBy(F.col(f"`{key}`")).agg(F.max(row).alias("all"), F.max(F.when(early, row)).alias("early"))
    same = F.col("all").eqNullSafe(F.col("early"))
    marked = lambda r, start, final: F.struct(r.alias("r"), F.lit(start).alias("start"), F.lit(final).alias("final"))
    both = F.when(same, F.array(marked(F.col("all"), True, True))).when(F.col("early").isNull(), F.array(marked(F.col("all"), False, True)))
    standing = best.select(F.explode(both.otherwise(F.array(marked(F.col("all"), False, True), marked(F.col("early"), True, False)))).alias("x"))
    return standing.select("x.r", "x.start", "x.final")


def placed(kept: DataFrame, key: str, time: str) -> DataFrame:
    """``day, t, s`` beside ``r``: where a row stands and what it is sorted by."""
    flat = kept.select("*", F.col(f"r.`{time}`").alias("_at"))
    at = micros(flat, "_at")
    return flat.select(
        day_of(at).alias("day"), F.coalesce(at, F.lit(NOTHING)).alias("t"), F.coalesce(F.col(f"r.`{key}`").cast("long"), F.lit(NOTHING)).alias("s"), *kept.columns
    )


def _place(days: np.ndarray, t: np.ndarray, s: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Of each row: the first entry of its day in the sorted table, and the number of entries at or below it."""
    d, tt, ss = table
    first = np.searchsorted(d, days, side="left")
    low, high = first.copy(), np.searchsorted(d, days, side="right")
    while (low < high).any():
        mid = np.minimum((low + high) // 2, len(d) - 1)
        below = (tt[mid] < t) | (tt[mid] == t) & (ss[mid] <= s)
        open_ = low < high
        low, high = np.where(open_ & below, mid + 1, low), np.where(open_ & ~below, mid, high)
    return first, low - first


def _arrays(entries: list[tuple[int, ...]], width: int) -> tuple[np.ndarray, ...]:
    return tuple(np.array([e[i] for e in entries], np.int64) for i in range(width))


def _binned(brackets: list[tuple[int, ...]]):
    """Rows of each task counted by bracket and bin; brackets are (day, least and greatest t, least and greatest s)."""
    d, t0, t1, s0, s1 = _arrays(brackets, 5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wide = t1 > t0
        low, high = np.where(wide, t0, s0).view(np.uint64), np.where(wide, t1, s1).view(np.uint64)
        step = (high - low) // np.uint64(BINS) + np.uint64(1)
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            rows = np.concatenate(held, axis=1)
            order = np.lexsort(rows[1::-1])
            which, bin_, n, ta, tb, sa, sb = rows[:, order]
            at = np.flatnonzero(np.r_[True, (which[1:] != which[:-1]) | (bin_[1:] != bin_[:-1])])
            columns = [which[at], bin_[at], np.add.reduceat(n, at), np.minimum.reduceat(ta, at), np.maximum.reduceat(tb, at), np.minimum.reduceat(sa, at), np.maximum.reduceat(sb, at)]
            held[:] = [np.stack(columns)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["which", "bin", "n", "t0", "t1", "s0", "s1"])

        for batch in batches:
            days, t, s = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("day", "t", "s"))
            first, number = _place(days, t, s, (d, t0, s0))
            which = first + number - 1
            ok = number > 0
            ok[ok] &= (t[ok] < t1[which[ok]]) | (t[ok] == t1[which[ok]]) & (s[ok] <= s1[which[ok]])
            which, t, s = which[ok], t[ok], s[ok]
            if len(which):
                value = np.where(wide[which], t, s).view(np.uint64)
                held.append(np.stack([which, ((value - low[which]) // step[which]).astype(np.int64), np.ones(len(which), np.int64), t, t, s, s]))
                if sum(h.shape[1] for h in held) > MOST:
                    counted()
        if held:
            yield counted()

    return run


def cuts(placed_rows: DataFrame, rows: int) -> list[tuple[int, int, int]]:
    """(day, t, s) of the first row of every file but each day's first, in order."""
    points = placed_rows.select("day", "t", "s")
    large = points.groupBy("day").agg(F.count("*").alias("n"), *[f(c).alias(f"{c}{i}") for c in "ts" for i, f in enumerate((F.min, F.max))]).where(F.col("n") > rows)
    # A bracket: day, bounds of t and s, rows of the day before it, rows in it.
    open_ = sorted((r["day"], r["t0"], r["t1"], r["s0"], r["s1"], 0, r["n"]) for r in large.collect())
    done: list[tuple[int, int, int]] = []
    while open_:
        # One row is left, or rows that nothing tells apart.
        done += [(b[0], b[1], b[3]) for b in open_ if b[1] == b[2] and b[3] == b[4]]
        open_ = [b for b in open_ if b[1] < b[2] or b[3] < b[4]]
        if not open_:
            break
        shape = "which long, bin long, n long, t0 long, t1 long, s0 long, s1 long"
        counted = points.mapInArrow(tidy(_binned([b[:5] for b in open_])), shape).groupBy("which", "bin").agg(
            F.sum("n").alias("n"), F.min("t0").alias("t0"), F.max("t1").alias("t1"), F.min("s0").alias("s0"), F.max("s1").alias("s1")
        )
        before = F.coalesce(F.sum("n").over(_running("which", "bin")), F.lit(0)) + F.element_at(F.array(*[F.lit(b[5]) for b in open_]), (F.col("which") + 1).cast("int"))
        # The last rank at or before a bin's last row, of those that are wanted, is not before the bin.
        ranked = counted.withColumn("before", before)
        last = F.floor((F.col("before") + F.col("n") - 1) / F.lit(rows)) * rows
        found = ranked.where((last >= F.col("before")) & (last > 0)).select("which", "bin", "n", "t0", "t1", "s0", "s1", "before").collect()
        open_ = sorted((open_[r["which"]][0], r["t0"], r["t1"], r["s0"], r["s1"], r["before"], r["n"]) for r in found)
    return sorted(done)


def _running(by: str, order: str):
    from pyspark.sql import Window

    return Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def routed(placed_rows: DataFrame, edges: list[tuple[int, int, int]]) -> DataFrame:
    """``placed_rows`` with ``file_no``."""
    table = _arrays(edges, 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("day", "t", "s")]
            yield batch.append_column("file_no", pa.array(_place(*key, table)[1]))

    if not edges:
        return placed_rows.withColumn("file_no", F.lit(0).cast("long"))
    return placed_rows.mapInArrow(run, StructType([*placed_rows.schema.fields, StructField("file_no", LongType())]))


def write(placed_rows: DataFrame, rows: int, columns: list[str], folder: str, names: tuple[str, str], mode: str) -> None:
    """The files of all days of ``placed_rows``; with mode ``overwrite``, files of the same day and number are replaced."""
    day, number = names
    laid = routed(placed_rows.select("day", "t", "s", "r"), cuts(placed_rows, rows)).repartition("day", "file_no").sortWithinPartitions("day", "file_no", "t", "s")
    out = laid.select(*[F.col(f"r.`{c}`").alias(c) for c in columns], F.col("day").alias(day), F.col("file_no").alias(number))
    out.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", 0).partitionBy(day, number).parquet(folder)


def data_files(spark: SparkSession, folder: str, names: tuple[str, str]) -> dict[str, tuple[int, int]]:
    """Path below the folder -> (day, file number) of every data file: as many as the layout has."""
    found = {}
    for path, _, _ in paths.listed(spark, f"{folder}/*/*/*.parquet"):
        rest = path.split(f"{folder.rsplit('/', 1)[-1]}/", 1)[1]
        day, number, _ = rest.split("/")
        found[rest] = int(day.removeprefix(f"{names[0]}=")), int(number.removeprefix(f"{names[1]}="))
    return found


def overwrite_late(spark: SparkSession, table: DataFrame, rows: int, folder: str, stand: str, limit: int, key: str = "sale_id", time: str = "sold_at", arrival: str = "arrived_at") -> DataFrame:
    """Write the layout of the early rows to ``folder``, then make it the layout of all rows; describes the files (see ``described``).

    ``rows`` is the number of rows of a file, ``limit`` the time (in microseconds since 1970) from which rows are late, ``stand`` a path for the rows that stand in one of the layouts.
    """
    columns = table.columns
    names = tuple(free_name(table, n) for n in ("day", "file_no"))
    placed(kept_rows(table, key, arrival, limit), key, time).write.option("compression", "zstd").parquet(stand)
    held = spark.read.parquet(stand)
    write(held.where("start"), rows, columns, folder, names, "append")
    before = data_files(spark, folder, names)
    # A key whose row is not the same in both layouts has a late one: its own day and the day it stood in.
    touched = held.where("start <> final").select("day").distinct()
    renewed = held.where("final").join(touched, "day", "left_semi")
    write(renewed, rows, columns, folder, names, "overwrite")
    after = data_files(spark, folder, names)
    fresh = {place for path, place in after.items() if path not in before}
    # What a touched day no longer has: files beyond its last one, or all where its rows have gone.
    days = {r["day"] for r in touched.collect()}
    for path, place in before.items():
        if path in after and place[0] in days and place not in fresh:
            paths.delete(spark, f"{folder}/{path.rsplit('/', 1)[0]}")
    return described(spark, folder, columns, names, set(before), key, time, arrival)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of the comma-joined keys of each file, whose rows follow each other; only the digest is held."""
    last, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"path": [last], "ids_sha256": [digest.hexdigest()]})

    for batch in batches:
        for path, key in zip(batch.column("path").to_pylist(), batch.column("key").to_pylist(), strict=True):
            if path != last:
                if last is not None:
                    yield row()
                last, digest = path, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(key.encode())
    if last is not None:
        yield row()


def described(spark: SparkSession, folder: str, columns: list[str], names: tuple[str, str], before: set[str], key: str, time: str, arrival: str, amount: str = "total") -> DataFrame:
    """Each file of a layout, read back: its day, number, rows, digests of them, its columns, and whether it is not of ``before``."""
    shape = "day long, file_no long, n_rows long, cents long, rows_crc long, path string, columns string, ids_sha256 string, rewritten boolean"
    if not data_files(spark, folder, names):
        return spark.createDataFrame([], shape)
    stored = spark.read.option("mergeSchema", True).parquet(folder)
    held = [c for c in stored.columns if c not in names]
    rest = F.substring_index("_metadata.file_path", f"{folder.rsplit('/', 1)[-1]}/", -1)
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    cents = F.coalesce(F.floor(100 * F.col(f"`{amount}`") + 0.5).cast("long"), F.lit(0).cast("long")) if amount in held else F.lit(0).cast("long")
    rows = stored.select(
        F.col(names[0]).cast("long").alias("day"), F.col(names[1]).cast("long").alias("file_no"), rest.alias("path"), F.col("_metadata.row_index").alias("place"), text(F.col(f"`{key}`")).alias("key"),
        cents.alias("cents"), F.concat_ws(":", *[text(c) for c in (F.col(f"`{key}`"), micros(stored, time), micros(stored, arrival))]).alias("line"),
    )
    sums = rows.groupBy("day", "file_no", "path").agg(F.count("*").alias("n_rows"), F.sum("cents").alias("cents"), F.sum(F.crc32("line")).alias("rows_crc"))
    digests = rows.select("path", "place", "key").repartition("path").sortWithinPartitions("path", "place").mapInArrow(tidy(_hashed), "path string, ids_sha256 string")
    old = F.col("path").isin(sorted(before)) if before else F.lit(False)
    return sums.join(digests, "path").select(
        "day", "file_no", "n_rows", "cents", "rows_crc", F.concat(F.lit(f"{folder}/"), "path").alias("path"), F.lit(",".join(held)).alias("columns"), "ids_sha256", (~old).alias("rewritten")
    )
