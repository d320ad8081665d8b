"""Quantiles with a bounded rank error: one mergeable sketch a day, kept, and merged over any window of days.

A sketch holds a few thousand numbers whatever the day holds, partial ones meet in Spark's aggregation, and a window reads sketches, not rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 400
RANK_ERROR = 0.01  # of a merged sketch of this size, with 99 % confidence


def daily(rows: DataFrame, day: str, value: str, size: int = SIZE) -> DataFrame:
    """``day, n, sketch``; nulls and NaN do not count, infinite values do."""
    v = F.col(value).cast("double")
    counted = F.when(~F.isnan(v), v)
    return rows.where(F.col(day).isNotNull() & counted.isNotNull()).groupBy(F.col(day).alias("day")).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(counted, F.lit(size)).alias("sketch"))


def windows(sketches: DataFrame, days: int, size: int = SIZE) -> DataFrame:
    """``last, n, sketch`` for every stored day: all sketches of the ``days`` days up to it."""
    spread = sketches.select(F.explode(F.sequence(F.lit(0), F.lit(days - 1))).alias("k"), "*").select(F.date_add("day", F.col("k")).alias("last"), "n", "sketch")
    kept = spread.join(sketches.select(F.col("day").alias("last")), "last", "left_semi")
    return kept.groupBy("last").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", F.lit(size)).alias("sketch"))


def quantiles(sketched: DataFrame, shares: list[float]) -> DataFrame:
    """The sketch column as ``q0, q1, ...``, the values at these shares."""
    return sketched.select(*[c for c in sketched.columns if c != "sketch"], *[F.kll_sketch_get_quantile_double("sketch", F.lit(s)).alias(f"q{i}") for i, s in enumerate(shares)])
