"""Samples of a fixed size that do not depend on how rows are dealt over tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PARTS = 64


def least_hashes(rows: DataFrame, strata: list[str], key: str, size: int, seed: str = "sample", parts: int = PARTS) -> DataFrame:
    """``size`` rows of every stratum (all of a smaller one): those of the least hash of their key, then the least keys.

    A large stratum is ranked in parts first: a part keeps its own ``size`` least, and only these meet (at most ``parts * size`` rows a
    stratum).  Spark keeps the first rows of each group below such a rank before it shuffles them.
    """
    order = [F.col("_hash"), F.col(key)]
    hashed = rows.withColumn("_hash", F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string"))))
    part = F.pmod(F.xxhash64(key), F.lit(parts))
    first = hashed.withColumn("_n", F.row_number().over(Window.partitionBy(*strata, part).orderBy(*order))).where(F.col("_n") <= size)
    best = first.withColumn("_n", F.row_number().over(Window.partitionBy(*strata).orderBy(*order))).where(F.col("_n") <= size)
    return best.drop("_hash", "_n")
