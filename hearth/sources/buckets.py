"""A table laid out by a hash of its key, and loads that rewrite only the parts that hold keys of the load.

Rows lie at ``bucket=<n>/``; the number of buckets is the table's own and part of its path.  A load reads and overwrites the buckets of its
keys (Spark commits them together when the job ends); all other files stay as they are.  A load of few keys into a table of any size
so costs a few buckets, and neither side is gathered: the buckets that a load touches are at most all of them, a fixed number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearth.sources import paths, tables

BUCKETS = 64
# Whether a join deals out anew what is dealt out by some of its keys.
BY_ALL_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def _folder(path: str, buckets: int) -> str:
    return f"{path}/of={buckets}"


def _laid(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """The rows dealt out by their ``bucket``, to as many tasks."""
    return rows.withColumn("bucket", _bucket(keys, buckets)).repartition(buckets, "bucket")


def _write(laid: DataFrame, path: str, buckets: int, mode: str) -> None:
    with tables.released(laid.sparkSession):
        laid.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(_folder(path, buckets))


def create(rows: DataFrame, path: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Write a new table; rows have no column ``bucket`` or ``of``."""
    _write(_laid(rows, keys, buckets), path, buckets, "errorifexists")


def read(spark: SparkSession, path: str, buckets: int = BUCKETS) -> DataFrame:
    return spark.read.parquet(_folder(path, buckets)).drop("bucket")


def files(spark: SparkSession, path: str, buckets: int = BUCKETS) -> list[tuple[str, int, int]]:
    """(path, bytes, time of change) of the table's data files."""
    return paths.listed(spark, f"{_folder(path, buckets)}/bucket=*/*.parquet")


def merge_into(spark: SparkSession, path: str, staged: DataFrame, keys: list[str], better: Callable[[str, str], Column] | None = None, buckets: int = BUCKETS) -> dict[str, int]:
    """Load ``staged`` (one row of a key): new keys are inserted, known ones updated where ``better("s", "t")`` says so, always by default.

    Returns how many rows of the buckets read were inserted, updated, skipped and kept, counted by the job that writes them.
    Null keys equal each other.  Both sides are dealt out by bucket, once: so joined, rows lie as they are written.
    """
    from pyspark.sql import Observation

    touched = sorted(r[0] for r in staged.select(_bucket(keys, buckets)).distinct().collect())
    if not touched:
        return dict.fromkeys(("inserted", "updated", "skipped", "kept"), 0)
    stored = spark.read.parquet(_folder(path, buckets)).where(F.col("bucket").isin(touched)).drop("bucket")
    columns = stored.columns
    t = _laid(stored, keys, buckets).select(F.struct(*columns).alias("t"), F.col("bucket").alias("_t"), *[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)])
    s = _laid(staged, keys, buckets).select(F.struct(*columns).alias("s"), F.col("bucket").alias("_s"), *[F.col(k).alias(f"_s{i}") for i, k in enumerate(keys)])
    on = [F.col("_t") == F.col("_s"), *[F.col(f"_t{i}").eqNullSafe(F.col(f"_s{i}")) for i in range(len(keys))]]
    wins = F.lit(True) if better is None else F.coalesce(better("s", "t"), F.lit(False))
    action = F.when(F.col("t").isNull(), "inserted").when(F.col("s").isNull(), "kept").when(wins, "updated").otherwise("skipped")
    seen = Observation()
    decided = t.join(s, on, "full").withColumn("action", action)
    counted = decided.observe(seen, *[F.count(F.when(F.col("action") == a, 1)).alias(a) for a in ("inserted", "updated", "skipped", "kept")])
    row = F.when(F.col("action").isin("inserted", "updated"), F.col("s")).otherwise(F.col("t"))
    before = spark.conf.get(BY_ALL_KEYS)
    spark.conf.set(BY_ALL_KEYS, "false")
    try:
        _write(counted.select(row.alias("r"), F.coalesce("_t", "_s").alias("bucket")).select("r.*", "bucket"), path, buckets, "overwrite")
    finally:
        spark.conf.set(BY_ALL_KEYS, before)
    return dict(seen.get)


def by_score(s: str, t: str) -> Column:
    """A higher score, or no lower one and a newer time."""
    score, time = (lambda side: F.col(f"{side}.score")), (lambda side: F.col(f"{side}.processing_timestamp"))
    return (score(s) > score(t)) | ((score(s) >= score(t)) & (time(s) > time(t)))
