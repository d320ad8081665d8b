"""Exact quantiles without gathering a column: counts by bins, narrowed to the bins that hold the wanted ranks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

BINS = 2048  # bins of a pass and bracket: what comes to the driver
FEW = 4096  # values of a bracket that are sorted and read


def exact(rows: DataFrame, column: str, shares: list[float]) -> list[float | None]:
    """Quantiles with linear interpolation between neighbours; nulls do not count, without values all are None.

    Each pass over the column counts it by equal bins between the bounds of every open bracket, and keeps the bins in which wanted
    ranks lie.  The caller persists a column that is costly to make.  Infinite values and NaN (above all others) are counted
    apart, so that brackets are finite; between infinite neighbours there is nothing to interpolate, their mean is taken as Python does.
    """
    every = rows.select(F.col(column).cast("double").alias("v")).where("v is not null")
    endless = F.abs("v") == math.inf
    v = every.where(~F.isnan("v") & ~endless)
    n, low, high, below, above = every.agg(
        F.count("*"), *[f(F.when(~F.isnan("v") & ~endless, F.col("v"))) for f in (F.min, F.max)], F.count(F.when(F.col("v") == -math.inf, 1)), F.count(F.when(F.col("v") == math.inf, 1))
    ).first()
    if not n:
        return [None] * len(shares)
    finite = 0 if low is None else v.count() if below or above or every.where(F.isnan("v")).take(1) else n
    places = [(n - 1) * s for s in shares]
    wanted = sorted({r for p in places for r in (math.floor(p), math.ceil(p))})
    inside = [r for r in wanted if below <= r < below + finite]
    value: dict[int, float] = {r: -math.inf if r < below else math.inf if r < below + finite + above else math.nan for r in wanted if r not in inside}
    brackets = [(low, high, below, finite, inside)] if inside else []  # bounds, values before, values inside, ranks
    while brackets:
        open_ = []
        for lo, hi, before, inside, ranks in brackets:
            if lo == hi:
                value.update(dict.fromkeys(ranks, lo))
            elif inside <= FEW:
                found = [r["v"] for r in v.where(F.col("v").between(lo, hi)).orderBy("v").collect()]
                value.update({r: found[r - before] for r in ranks})
            else:
                open_.append((lo, hi, before, ranks))
        if not open_:
            break
        which, bin_ = F.lit(None).cast("int"), F.lit(0)
        for i, (lo, hi, _, _) in enumerate(open_):
            inside = F.col("v").between(lo, hi)
            which = F.when(inside, i).otherwise(which)
            bin_ = F.when(inside, F.least(F.floor((F.col("v") / 2 - lo / 2) / (hi / 2 - lo / 2) * BINS), F.lit(BINS - 1)) if hi / 2 > lo / 2 else F.when(F.col("v") == lo, 0).otherwise(1)).otherwise(bin_)
        counted = v.groupBy(which.alias("which"), bin_.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        bins: dict[int, list] = {}
        for r in counted.where("which is not null").orderBy("which", "bin").collect():
            bins.setdefault(r["which"], []).append(r)
        brackets = []
        for i, (_, _, before, ranks) in enumerate(open_):
            for b in bins[i]:
                mine = [r for r in ranks if before <= r < before + b["n"]]
                if mine:
                    brackets.append((b["lo"], b["hi"], before, b["n"], mine))
                before += b["n"]

    return [_between(value, p) for p in places]


def _between(value: dict[int, float], p: float) -> float:
    a, b, part = value[math.floor(p)], value[math.ceil(p)], p - math.floor(p)
    if a == b or not part:
        return a
    # Differences of very large values of either sign would leave the range of doubles.
    return a + part * (b - a) if math.isfinite(b - a) else a * (1 - part) + b * part


def exact_by(rows: DataFrame, by: list[str], column: str, shares: list[float], most: int = 1000) -> dict[tuple, list[float]]:
    """The quantiles of every group of ``by`` (null is a group too), by the same passes for all groups at once: no group is sorted in one task.

    Groups without a value are left out.  Open brackets are sent to the tasks as a table of at most two rows a group and share;
    more than ``most`` groups are an error.  The more brackets are open, the fewer bins each has and the fewer of its values are read.
    """
    keys = [f"g{i}" for i in range(len(by))]
    every = rows.select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(column).cast("double").alias("v")).where("v is not null")
    usual = ~F.isnan("v") & (F.abs("v") != math.inf)
    finite = every.where(usual)
    groups = every.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count_if(usual).alias("finite"), F.count_if(F.col("v") == -math.inf).alias("below"), F.count_if(F.col("v") == math.inf).alias("above"),
        F.min(F.when(usual, F.col("v"))).alias("lo"), F.max(F.when(usual, F.col("v"))).alias("hi"),
    ).limit(most + 1).collect()
    if len(groups) > most:
        raise ValueError(f"more than {most} groups")
    places, value, brackets = {}, {}, []
    for r in groups:
        g = tuple(r[k] for k in keys)
        places[g] = [(r["n"] - 1) * s for s in shares]
        wanted = sorted({i for p in places[g] for i in (math.floor(p), math.ceil(p))})
        inside = [i for i in wanted if r["below"] <= i < r["below"] + r["finite"]]
        value[g] = {i: -math.inf if i < r["below"] else math.inf if i < r["below"] + r["finite"] + r["above"] else math.nan for i in wanted if i not in inside}
        if inside:
            brackets.append((g, r["lo"], r["hi"], r["below"], r["finite"], inside))
    schema = StructType([*[StructField(f"b{k}", every.schema[k].dataType) for k in keys], StructField("which", IntegerType()), StructField("lo", DoubleType()), StructField("hi", DoubleType())])

    def within(wanted: list[tuple]) -> DataFrame:
        table = rows.sparkSession.createDataFrame([(*g, i, lo, hi) for i, (g, lo, hi, *_) in enumerate(wanted)], schema)
        on = F.col("v").between(F.col("lo"), F.col("hi"))
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"b{k}"))
        return finite.join(F.broadcast(table), on)

    while brackets:
        bins, few = (max(least, min(most_, 32 * most_ // len(brackets))) for least, most_ in ((16, BINS), (64, FEW)))
        few_left, open_ = [], []
        for b in brackets:
            g, lo, hi, before, inside, ranks = b
            if lo == hi:
                value[g].update(dict.fromkeys(ranks, lo))
            else:
                (few_left if inside <= few else open_).append(b)
        if few_left:
            found: dict[int, list[float]] = {}
            for r in within(few_left).select("which", "v").collect():
                found.setdefault(r["which"], []).append(r["v"])
            for i, (g, _, _, before, _, ranks) in enumerate(few_left):
                ordered = sorted(found[i])
                value[g].update({r: ordered[r - before] for r in ranks})
        if not open_:
            break
        # Halved, so that differences stay in the range of doubles; bounds too close for that are told apart as the lower one and the rest.
        half = F.col("hi") / 2 - F.col("lo") / 2
        place = F.when(half > 0, F.least(F.floor(F.try_divide(F.col("v") / 2 - F.col("lo") / 2, half) * bins), F.lit(bins - 1))).otherwise((F.col("v") > F.col("lo")).cast("long"))
        counted = within(open_).groupBy("which", place.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        by_bracket: dict[int, list] = {}
        for r in counted.orderBy("which", "bin").collect():
            by_bracket.setdefault(r["which"], []).append(r)
        brackets = []
        for i, (g, _, _, before, _, ranks) in enumerate(open_):
            for b in by_bracket[i]:
                mine = [r for r in ranks if before <= r < before + b["n"]]
                if mine:
                    brackets.append((g, b["low"], b["high"], before, b["n"], mine))
                before += b["n"]
    return {g: [_between(value[g], p) for p in places[g]] for g in places}
