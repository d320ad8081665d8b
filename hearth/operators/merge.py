"""Upsert by rule without a transactional table format: one full outer join decides every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _decided(target: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    t = target.select(F.struct(*target.columns).alias("t"), F.col(key).alias("tk"))
    s = staged.select(F.struct(*target.columns).alias("s"), F.col(key).alias("sk"))
    better = (F.col("s.score") > F.col("t.score")) | ((F.col("s.score") >= F.col("t.score")) & (F.col("s.processing_timestamp") > F.col("t.processing_timestamp")))
    action = F.when(F.col("tk").isNull(), "inserted").when(F.col("sk").isNull(), "kept").when(better, "updated").otherwise("skipped")
    return t.join(s, F.col("tk") == F.col("sk"), "full").withColumn("action", action)


def upsert(target: DataFrame, staged: DataFrame, key: str = "id") -> DataFrame:
    """The table after the load: a staged row replaces a row of lower score, or of no higher score and older time.

    ``staged`` holds one row of a key (see ``dedup.best_of``).
    """
    d = _decided(target, staged, key)
    row = F.when(F.col("action").isin("inserted", "updated"), F.col("s")).otherwise(F.col("t"))
    return d.select(row.alias("r")).select("r.*")


def upsert_counts(target: DataFrame, staged: DataFrame, key: str = "id") -> DataFrame:
    """Rows really inserted, updated, skipped and kept."""
    return _decided(target, staged, key).groupBy("action").agg(F.count("*").alias("n"))
