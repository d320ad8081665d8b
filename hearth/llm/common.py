"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(module: str) -> None:
    """Send a module's functions to the workers by value, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named input table, through Spark's reader only (any store Spark can open works)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one is set only where none is and all runs on one machine (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="hearth-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Frames made and run inside leave no shuffle files behind once their action ends.

    By themselves those files stay on the executors' disks until the driver happens to collect garbage.  A frame that is run again makes
    them anew.
    """
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def cut(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Lineage cut through a reliable checkpoint in the shared folder; the shuffle files behind it go as soon as it stands."""
    folder = checkpoint_dir(spark)
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    with released(spark):
        return df.select("*").checkpoint(eager=True)


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, for a dataset that is written and read back."""
    return f"{checkpoint_dir(spark)}/hearth-{name}-{uuid.uuid4().hex}"


HOT_KEYS = 1024  # a key is hot if it holds over this part of the rows, so there are fewer hot keys than this
HOT_ROWS = 256


def hot_keys(counts: DataFrame, key: str, total: int) -> dict:
    """Into how many parts to deal the rows of each hot key, from its number ``n`` of rows in ``counts``.

    A key is hot above ``total / HOT_KEYS`` rows (``HOT_ROWS`` at least), ``total`` being no less than the number of all rows:
    that bounds what comes to the driver to ``HOT_KEYS`` keys.
    """
    limit = max(HOT_ROWS, total // HOT_KEYS)
    with released(counts.sparkSession):
        return {r[0]: r[1] for r in counts.where(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).cast("int")).collect()}


def spread_join(many: DataFrame, one: DataFrame, key: str, hot: dict) -> DataFrame:
    """Inner join of ``many`` with the few rows of each key in ``one``; the rows of a hot key are dealt over several tasks.

    They are dealt by a hash of the row into the parts that ``hot`` names, and what ``one`` has for the key is copied to each part.
    """
    if not hot:
        return many.join(one, key)
    kind = many.schema[key].dataType
    known = F.create_map(*(c for k, n in hot.items() for c in (F.lit(k).cast(kind), F.lit(n))))
    parts = F.coalesce(F.try_element_at(known, F.col(key)), F.lit(1))
    dealt = many.withColumn("_part", F.pmod(F.xxhash64(*many.columns), parts).cast("int"))
    copies = one.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.join(copies, [key, "_part"]).drop("_part")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A worker's function that gives its memory back to the system when its task ends, as workers are kept for the next one."""

    def tidied(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return tidied


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Consecutive row slices of a batch whose texts hold about ``most`` bytes together (one row at least).

    Keeps the working set of a Python worker bounded whatever the batch size setting and however long a text is.
    """
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    begin, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += n + 64
    if begin < batch.num_rows:
        yield batch.slice(begin)
