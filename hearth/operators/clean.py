"""Range filters, imputation, outliers, splits and balancing; statistics come from one aggregation each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hearth.operators import quantiles

# Hard and configured ranges.
CRITICAL = {"price": (1e8, 1e11), "area": (10.0, 10000.0), "latitude": (8.0, 24.0), "longitude": (102.0, 110.0), "province_id": (1, 63)}
CONFIGURED = {"price": (5e8, 1e11), "area": (10.0, 1000.0), "floor_count": (1, 50)}


def in_ranges(ranges: dict, optional: tuple[str, ...] = ()) -> Column:
    """All columns inside their ranges; null passes for optional ones only."""
    whole = F.lit(True)
    for name, (low, high) in ranges.items():
        inside = F.col(name).between(low, high)
        whole = whole & (F.col(name).isNull() | inside if name in optional else inside)
    return whole


def checked(rows: DataFrame, wanted: Column, least: float = 0.2) -> DataFrame:
    """The rows for which ``wanted`` holds, or an error where none of some is left; both counts come from one pass."""
    n, m = rows.agg(F.count("*"), F.count_if(wanted)).first()
    if n and not m:
        raise ValueError("all rows were filtered out")
    if n and m / n < least:
        import warnings

        warnings.warn(f"{1 - m / n:.0%} of the rows were filtered out", stacklevel=2)
    return rows.where(wanted)


# What a row must hold at the end.
FINAL = CRITICAL | {"floor_count": (1, 99)}


def valid(rows: DataFrame, ranges: dict = FINAL, optional: tuple[str, ...] = ("floor_count",)) -> DataFrame:
    """The rows inside all ranges; ranges of columns that are not there are left out."""
    return rows.where(in_ranges({c: r for c, r in ranges.items() if c in rows.columns}, optional))


def removed(rows: DataFrame, ranges: dict = FINAL, optional: tuple[str, ...] = ("floor_count",)) -> DataFrame:
    """``rule, removed, kept``: how many rows each range takes from what the ranges before it leave, from one pass."""
    left, parts = F.lit(True), []
    for i, (c, r) in enumerate((c, r) for c, r in ranges.items() if c in rows.columns):
        ok = F.coalesce(in_ranges({c: r}, optional), F.lit(False))
        parts.append(F.struct(F.lit(i).alias("place"), F.lit(c).alias("rule"), F.count_if(left & ~ok).alias("removed"), F.count_if(left & ok).alias("kept")).alias(f"r{i}"))
        left = left & ok
    return rows.agg(*parts).select(F.inline(F.array(*[f"r{i}" for i in range(len(parts))])))


def impute(rows: DataFrame, medians: list[str], unknown_ids: list[str], texts: list[str], required: list[str]) -> DataFrame:
    """Rows without a required value go; medians fill numbers, -1 fills ids, ``unknown`` fills texts.

    The medians are exact and found before, from the columns alone.
    """
    for name in required:
        rows = rows.where(F.col(name).isNotNull())
    held = rows.select(*medians).persist()
    try:
        typical = {c: quantiles.exact(held, c, [0.5])[0] for c in medians}
    finally:
        held.unpersist()
    values = {c: F.coalesce(F.col(c).cast("double"), F.lit(typical[c]).cast("double")) for c in medians}
    values |= {c: F.coalesce(F.col(c), F.lit(-1)) for c in unknown_ids} | {c: F.coalesce(F.col(c), F.lit("unknown")) for c in texts}
    return rows.withColumns(values)


def iqr_bounds(rows: DataFrame, column: str, factor: float = 1.5) -> tuple[float | None, float | None]:
    low, high = quantiles.exact(rows, column, [0.25, 0.75])
    return (None, None) if low is None else (low - (high - low) * factor, high + (high - low) * factor)


def z_bounds(rows: DataFrame, column: str, most: float = 3.0) -> tuple[float | None, float | None]:
    mean, dev = rows.agg(F.avg(column).cast("double"), F.stddev_samp(column).cast("double")).first()
    return (None, None) if dev is None else (mean - dev * most, mean + dev * most)


def without_outliers(rows: DataFrame, method: str, columns: list[str]) -> DataFrame:
    """Column after column, each by the bounds of what the one before left; the columns are read once."""
    if method == "none":
        return rows
    bounds = {"iqr": iqr_bounds, "zscore": z_bounds}[method]
    held = rows.select(*columns).persist()
    kept = F.lit(True)
    try:
        for c in columns:
            kept = kept & F.col(c).cast("double").between(*[F.lit(b).cast("double") for b in bounds(held.where(kept), c)])
    finally:
        held.unpersist()
    return rows.where(kept)


def hash_split(key: Column, percent: int) -> Column:
    """True for about ``percent`` of the keys, the same ones on every run and engine."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("int"), F.lit(100)) < percent


def earliest(rows: DataFrame, share: float, key: str = "listing_key") -> DataFrame:
    """The first share of the rows by day, then ``key``, marked in ``train``; rows without a day are left out.

    Counts by day tell the border day, and one row of that day the border key, so that no row is ranked or moved.
    """
    day = F.to_date("posted_date")
    dated = rows.where(day.isNotNull())
    counts = dated.groupBy(day.alias("_day")).agg(F.count("*").alias("_n"))
    w = Window.partitionBy(F.lit(1)).orderBy("_day")
    ahead = counts.select("_day", (F.sum("_n").over(w) - F.col("_n")).alias("before"), F.sum("_n").over(Window.partitionBy(F.lit(1))).alias("all"))
    border = ahead.withColumn("last", F.floor(F.col("all") * share)).where("before < last").orderBy(F.desc("_day")).limit(1).first()
    if border is None:
        return dated.withColumn("train", F.lit(False))
    inside = dated.where(day == F.lit(border["_day"])).select(key).orderBy(key).offset(border["last"] - border["before"] - 1).limit(1).first()
    return dated.withColumn("train", (day < F.lit(border["_day"])) | ((day == F.lit(border["_day"])) & (F.col(key) <= F.lit(inside[0]))))


def balanced(rows: DataFrame, key: str, cap: float = 1.2, by: str = "listing_key") -> DataFrame:
    """The largest group cut to ``cap`` times the second largest, by the order of a hash of its rows' keys.

    Counts by the first digits of the hash tell where the cut lies, and one row there its very place: no group is sorted.
    """
    first = rows.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key).limit(2).collect()
    if len(first) < 2 or first[0]["n"] <= int(first[1]["n"] * cap):
        return rows
    left = int(first[1]["n"] * cap)
    largest, hashed = F.col(key).eqNullSafe(F.lit(first[0][0])), F.md5(F.col(by).cast("string"))
    digits = F.substring(hashed, 1, 4)
    counts = rows.where(largest).groupBy(digits.alias("d")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(F.lit(1)).orderBy("d")
    border = counts.withColumn("before", F.sum("n").over(w) - F.col("n")).where(F.col("before") < left).orderBy(F.desc("d")).limit(1).first()
    place = F.struct(hashed.alias("h"), F.col(by).alias("k"))
    last = rows.where(largest & (digits == border["d"])).select(place.alias("p")).orderBy("p").offset(left - border["before"] - 1).limit(1).first()["p"]
    kept = (hashed < last["h"]) | ((hashed == last["h"]) & (F.col(by) <= F.lit(last["k"])))
    return rows.where(~largest | kept)
