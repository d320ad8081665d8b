"""Session settings for batch runs, and the command line of the daily pipeline."""

from __future__ import annotations

import argparse
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Adaptive execution sizes and splits shuffle partitions at run time; the initial number is only an upper bound.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(name: str, settings: dict[str, str] | None = None) -> SparkSession:
    return SparkSession.builder.appName(name).config(map=SETTINGS | (settings or {})).getOrCreate()


def observed(rows: DataFrame, name: str) -> tuple[DataFrame, object]:
    """Row count of a stage as a by-product of the job that runs it anyway."""
    from pyspark.sql import Observation

    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


@contextmanager
def timed(spark: SparkSession, name: str, log: Callable[[str], None] = print) -> Iterator[None]:
    """Reports how long a step took, with the jobs and stages still running at its end."""
    began = time.monotonic()
    try:
        yield
    finally:
        tracker = spark.sparkContext.statusTracker()
        log(f"{name}: {time.monotonic() - began:.2f} s, {len(tracker.getActiveJobsIds())} jobs and {len(tracker.getActiveStageIds())} stages running")


def release(spark: SparkSession, *frames: DataFrame) -> None:
    """Give cached frames back, or all of the session's where none is named."""
    for frame in frames:
        frame.unpersist()
    if not frames:
        spark.catalog.clearCache()


def set_options(spark: SparkSession, options: dict[str, str]) -> dict[str, str]:
    """Set what can be set while the session runs; returns what cannot."""
    left = {k: v for k, v in options.items() if not spark.conf.isModifiable(k)}
    for k in options.keys() - left.keys():
        spark.conf.set(k, options[k])
    return left


STAGES = ("bronze", "silver", "gold", "load")


def chosen(only: list[str] | None = None, skip: list[str] | None = None) -> list[str]:
    """The stages to run, in order."""
    unknown = {*(only or ()), *(skip or ())} - set(STAGES)
    if unknown:
        raise ValueError(f"unknown stages: {', '.join(sorted(unknown))}")
    return [s for s in STAGES if (not only or s in only) and s not in (skip or ())]


def run_daily(
    spark: SparkSession, raw_a: str | None, raw_b: str | None, hierarchy: str, out: str, day: str, run_id: str, stages: tuple[str, ...] | list[str] = STAGES[:3]
) -> DataFrame | None:
    """Raw files of a day to its gold partition; a missing source is left out, the address document must be there.

    Every stage writes the day's rows below ``out`` and the next one reads them, so a run may begin or end at any stage: what is left out
    must have run before.  ``load`` brings the day's gold rows into the serving table.  Without any gold stored the result is None.
    """
    from hearth.operators import etl
    from hearth.sources import paths, tables

    now = F.lit(day).cast("timestamp")
    dated = lambda rows: rows.withColumn("dt", F.lit(day).cast("date"))
    stored = lambda name: spark.read.parquet(f"{out}/{name}").where(F.col("dt") == F.lit(day).cast("date"))
    sources = {"a": (raw_a, tables.RAW_A, etl.silver_a), "b": (raw_b, tables.RAW_B, etl.silver_b)}
    if "bronze" in stages:
        if not raw_a and not raw_b:
            raise ValueError("no source was given")
        for name, (path, columns, _) in sources.items():
            if path:
                tables.write_days(dated(tables.read_raw(spark, path, columns)), f"{out}/bronze/{name}")
    present = [n for n, (path, _, _) in sources.items() if (path or "bronze" not in stages) and paths.exists(spark, f"{out}/bronze/{n}/dt={day}")]
    if "silver" in stages:
        dims = tables.hierarchy(spark.read.option("multiLine", True).json(hierarchy))
        for name in present:
            silver = etl.addressed(sources[name][2](stored(f"bronze/{name}").drop("dt"), now, run_id), dims)
            tables.write_days(dated(silver), f"{out}/silver/{name}")
    if "gold" in stages:
        silvers = [stored(f"silver/{n}").drop("dt") for n in present if paths.exists(spark, f"{out}/silver/{n}/dt={day}")]
        if not silvers:
            raise ValueError(f"nothing is stored for {day}")
        tables.write_days(dated(etl.gold(silvers)), f"{out}/gold", "dt", "property_type")
    if not paths.exists(spark, f"{out}/gold"):
        return None
    gold = stored("gold")
    if "load" in stages:
        etl.load_buckets(spark, f"{out}/serving", gold.drop("dt"), now)
    return gold


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Run the daily listings pipeline.")
    p.add_argument("--raw-a")
    p.add_argument("--raw-b")
    p.add_argument("--hierarchy", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--day", required=True, help="yyyy-mm-dd")
    p.add_argument("--run-id", default="manual")
    p.add_argument("--only", nargs="*", help=f"stages to run, of {', '.join(STAGES)}")
    p.add_argument("--skip", nargs="*", help="stages to leave out")
    a = p.parse_args(argv)
    rows = run_daily(get_session("listings-daily"), a.raw_a, a.raw_b, a.hierarchy, a.out, a.day, a.run_id, chosen(a.only, a.skip))
    print(rows.groupBy("source").count().collect() if rows is not None else "no gold rows")


if __name__ == "__main__":
    main()
