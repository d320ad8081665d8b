"""Listing streams: file source, keyed partitioned sink, duplicate removal and windowed counts.

At-least-once delivery with idempotent writes: progress is in the checkpoint, a micro-batch is committed as a whole.
The trigger bounds a micro-batch by time, ``files_per_batch`` by size.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType


def read_json(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def read_parquet(spark: SparkSession, path: str, files_per_batch: int = 16) -> DataFrame:
    """A folder of Parquet files as a stream; ``path`` may be a glob."""
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def read_messages(spark: SparkSession, servers: str, topic: str, rows_per_batch: int = 20_000, from_start: bool = True, kind: str = "kafka") -> DataFrame:
    """A topic as a stream, a micro-batch bounded by rows; offsets are committed by the query's checkpoint.

    The connector is not part of Spark itself: without it, starting the query fails.
    """
    reader = spark.readStream.format(kind).option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", "earliest" if from_start else "latest").option("maxOffsetsPerTrigger", rows_per_batch).option("failOnDataLoss", "false").load()


def read_bounded(spark: SparkSession, path: str, schema: StructType, batch_bytes: int = 128 << 20) -> DataFrame:
    """JSON files as a stream, a micro-batch bounded by bytes."""
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", batch_bytes).json(path)


def retried(write: Callable[[DataFrame, int], None], attempts: int = 3, wait: float = 1.0) -> Callable[[DataFrame, int], None]:
    """A micro-batch writer that is tried again after ``wait`` seconds, then twice as many and so on by that step."""

    def run(batch: DataFrame, number: int) -> None:
        for attempt in range(1, attempts + 1):
            try:
                return write(batch, number)
            except Exception:
                if attempt == attempts:
                    raise
                time.sleep(wait * attempt)

    return run


def until_idle(query: StreamingQuery, idle: float, poll: float = 1.0) -> None:
    """Stop a query that has read nothing for ``idle`` seconds, with all it has read written."""
    quiet_since, last = time.monotonic(), None
    while query.isActive:
        progress = query.lastProgress
        if progress and progress["batchId"] != last and progress["numInputRows"]:
            quiet_since, last = time.monotonic(), progress["batchId"]
        if time.monotonic() - quiet_since >= idle and not query.status["isTriggerActive"]:
            query.processAllAvailable()
            query.stop()
        time.sleep(poll)
    if query.exception():
        raise query.exception()


def decoded(messages: DataFrame, schema: StructType) -> DataFrame:
    """Records of JSON messages; text that is no JSON stays in ``raw``."""
    value = F.col("value").cast("string")
    parsed = messages.select(F.from_json(value, schema.add("_corrupt", "string"), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"), value.alias("v"))
    return parsed.select("r.*", F.when(F.col("r._corrupt").isNotNull(), F.col("v")).alias("raw")).drop("_corrupt")


def once_per_key(rows: DataFrame, key: list[str], time: str, expiry: str) -> DataFrame:
    """The first row of a key within the expiry; state older than it is dropped."""
    return rows.withWatermark(time, expiry).dropDuplicatesWithinWatermark(key)


def by_window(rows: DataFrame, time: str, width: str, late: str, *keys: str) -> DataFrame:
    counted = rows.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *keys)
    return counted.agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def by_session(rows: DataFrame, time: str, gap: str, late: str, key: str) -> DataFrame:
    grouped = rows.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key)
    return grouped.agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), "n")


def keyed_sink(rows: DataFrame, path: str, checkpoint: str, keys: list[str], seconds: int | None = 300) -> DataStreamWriter:
    """Partitioned Parquet files by key; without ``seconds`` all that is there is read once and the query ends."""
    writer = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*keys).outputMode("append")
    return writer.trigger(availableNow=True) if seconds is None else writer.trigger(processingTime=f"{seconds} seconds")


def run_once(rows: DataFrame, path: str, checkpoint: str, keys: list[str]) -> DataFrame:
    """Drain the source into the sink, then read the sink."""
    query = keyed_sink(rows, path, checkpoint, keys, None).start()
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def drained_by_part(rows: DataFrame, part: str, work: str, plan: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """The sink of a stream that lands part by part: every part is written to the source's folder and drained before the next one.

    ``part`` is a column of ``rows`` whose values, few by nature (days, halves of months), give the order of landing; null parts never land.
    ``plan`` makes the streaming result, in append mode.  Each drain starts the query anew from its checkpoint, so offsets, watermark and state
    outlive a restart; what the watermark has closed is in the sink and gone from the state, and rows that come after that are dropped.
    The rows are cut into parts in one pass.  An empty table gives an empty sink.
    """
    spark, source = rows.sparkSession, f"{work}/in"
    shape = rows.drop(part)
    rows.where(F.col(part).isNotNull()).write.partitionBy(part).parquet(f"{work}/parts")
    cut = spark.read.schema(rows.schema).parquet(f"{work}/parts")
    parts = [r[0] for r in cut.select(part).distinct().orderBy(part).collect()]
    stored = plan(shape.limit(0))
    for number, value in enumerate(parts):
        cut.where(F.col(part) == value).select(*shape.columns).write.parquet(f"{source}/{number:05d}")
        stored = run_once(plan(spark.readStream.schema(shape.schema).parquet(f"{source}/*")), f"{work}/out", f"{work}/checkpoint", keys)
    return stored
