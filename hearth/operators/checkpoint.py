"""Which crawled ids are new: the latest attempt of each id decides, old successes expire."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(attempts: DataFrame, key: str, time: str, *ties: str) -> DataFrame:
    """The last attempt of each key."""
    return attempts.groupBy(key).agg(F.max_by(F.struct(*attempts.columns), F.struct(time, *ties)).alias("r")).select("r.*")


def to_crawl(seen: DataFrame, attempts: DataFrame, key: str, time: str, ok: Column, now: Column, expiry_hours: int) -> DataFrame:
    """Ids without a last attempt that succeeded within the expiry."""
    fresh = latest(attempts, key, time).where(ok & (F.col(time) > now - F.make_interval(hours=F.lit(expiry_hours))))
    return seen.join(fresh.select(key), key, "left_anti")
