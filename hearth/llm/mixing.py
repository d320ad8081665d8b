"""Mixing sources to target weights, in DataFrame expressions only.

The words of every source are summed; weights are shared out over the total; a target stops at ``max_repeat`` times
its source's size and the excess is reshared by weight among the others until none is above.  In closed form the
target is ``min(max_repeat * size, level * weight)`` for the one level at which the targets add up to the total.  A
document is emitted floor(rate) times, rate being target / size of its source, and once more if its seeded hash falls
below the fraction.

Only one row per source is gathered (aggregated before the shuffle), so a source with a third of all rows is no
heavier than another.  The joined table of targets is broadcast only while it has at most ``broadcast_rows`` rows
(about 100 bytes each); beyond that Spark joins by key and splits skewed keys.

Defined cases: null text has size 0; a null source is a source of its own, last in order; sources without words get the
target 0 and their documents no copy; rows with equal ids (and null ids) share one draw, so repeated rows are treated
alike; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.llm.common import free_name

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_repeat: int = 3) -> DataFrame:
    """``source, source_size, target, rate`` from rows of ``source, size``; sources weigh by code point order, null last."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(1))  # over one row per source
    ordered = everything.orderBy(F.col("source").asc_nulls_last())
    place = ((F.row_number().over(ordered) - 1) % len(weights)).cast("int")
    weighed = sums.withColumn("weight", F.get(F.array(*[F.lit(w).cast("long") for w in weights]), place))
    cap = F.col("source_size") * max_repeat
    by_cap = everything.orderBy((cap.cast("double") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum(cap).over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    from_here = F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything)
    levels = weighed.select(
        "source", "source_size", "weight",
        F.row_number().over(by_cap).alias("place"),
        ((total - before).cast("double") / from_here.cast("double")).alias("level"),
    )
    fits = F.col("level") * F.col("weight") <= (F.col("source_size") * max_repeat).cast("double")
    # Level of the first source (by cap) that stays below its cap: all before it are at their caps.
    level = F.min(F.when(fits, F.struct("place", "level"))).over(everything)["level"]
    target = F.least((F.col("source_size") * max_repeat).cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target")).withColumn(
        "rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    )


def draw(doc_id: Column, seed: int) -> Column:
    """A uniform number in [0, 1) fixed by the id and the seed (52 bits of md5, so any SQL engine can repeat it)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(2**52)


def _joined(docs: DataFrame, targets: DataFrame, seed: int, broadcast_rows: int, names: dict[str, str]) -> DataFrame:
    """``docs`` with the target's columns and the number of copies, under the names given for them."""
    n = {c: names.get(c) or free_name(docs, f"_mix_{c}") for c in ("source", "source_size", "target", "rate", "copies")}
    t = targets.select(*[F.col(c).alias(n[c]) for c in ("source", "source_size", "target", "rate")])
    if t.count() <= broadcast_rows:
        t = F.broadcast(t)
    whole = F.floor(n["rate"])
    extra = (draw(F.col("doc_id"), seed) < F.col(n["rate"]) - whole).cast("long")
    joined = docs.join(t, docs["source"].eqNullSafe(t[n["source"]]), "left")
    return joined.withColumn(n["copies"], (whole + extra).cast("long")).drop(n["source"], n["rate"])


def with_copies(docs: DataFrame, targets: DataFrame, seed: int = 11, broadcast_rows: int = 100_000) -> DataFrame:
    """``docs`` with ``source_size, target, copies``; ``targets`` must be a table that is cheap to count."""
    return _joined(docs, targets, seed, broadcast_rows, {c: c for c in ("source_size", "target", "copies")})


def emit(docs: DataFrame, targets: DataFrame, seed: int = 11, broadcast_rows: int = 100_000) -> DataFrame:
    """The mixed corpus: every document as often as its source's rate says, with the columns of ``docs``."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    copies = free_name(docs, "_mix_copies")
    many = _joined(docs, targets, seed, broadcast_rows, {"copies": copies}).where(F.col(copies) > 0)
    return many.withColumn(free_name(many, "_copy"), F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*columns)
