"""Readers and writers: raw JSON lines, day partitions, CSV, JDBC, file streams and sized micro-batch files.

Paths go through Spark's readers and writers only, so any store Spark can open will do.
"""

from __future__ import annotations

import re
import tempfile
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from hearth.sources import paths

# The columns of the two raw sources; all are strings.
RAW_A = (
    "area, bathroom, bedroom, crawl_timestamp, data_type, description, facade_width, floor_count, house_direction, interior, latitude, legal_status, location, longitude, "
    "posted_date, price, price_per_m2, road_width, seller_info, source, title, url"
)
RAW_B = (
    "area, bathroom, bedroom, crawl_timestamp, data_type, description, floor_count, house_direction, house_type, interior, latitude, legal_status, length, living_size, location, "
    "longitude, posted_date, price, price_per_m2, seller_info, source, title, url, width"
)


def work_path(spark: SparkSession) -> str:
    """A new folder in the shared checkpoint folder, or a temporary one where none is named and all runs on one machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    return f"{named or tempfile.mkdtemp()}/hearth-stream-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Frames made and run inside leave no shuffle files behind once their action ends.

    By themselves those files stay on the executors' disks until the driver happens to collect garbage.
    """
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def stored(rows: DataFrame) -> DataFrame:
    """The rows written once to a new folder and read back, for what reads them more than once: the joins that make them run once."""
    path = f"{work_path(rows.sparkSession)}/rows"
    with released(rows.sparkSession):
        rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def strings(columns: str) -> StructType:
    return StructType([StructField(c.strip(), StringType()) for c in columns.split(",")])


def read_raw(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """JSON lines with a fixed schema; empty texts are nulls from here on."""
    rows = spark.read.schema(strings(columns)).json(path)
    return rows.select(*[F.nullif(F.trim(F.col(c)), F.lit("")).alias(c) for c in rows.columns])


def with_run(rows: DataFrame, day: str, run_id: str, source: str) -> DataFrame:
    """Run columns from literals, so that a run can be repeated."""
    return rows.withColumns({"processing_date": F.lit(day).cast("date"), "processing_id": F.lit(run_id), "data_source": F.lit(source)})


def read_days(spark: SparkSession, path: str, last: str, days: int, columns: list[str] | None = None, day: str = "dt") -> DataFrame:
    """The days up to ``last`` of a table partitioned by day: one pruned scan, missing days cost nothing."""
    end = F.lit(last).cast("date")
    rows = spark.read.parquet(path).where(F.col(day).cast("date").between(F.date_sub(end, days - 1), end))
    return rows.select(*columns, day) if columns else rows


def read_latest(spark: SparkSession, path: str, last: str, most: int = 90, day: str = "dt") -> DataFrame:
    """The latest day within ``most`` days up to ``last``."""
    rows = read_days(spark, path, last, most, day=day)
    newest = rows.agg(F.max(day).alias(day))
    return rows.join(F.broadcast(newest), day)


def days_before(last: DataFrame, days: int) -> DataFrame:
    """The ``days`` days up to the one day ``last``, as ``dt``."""
    # A filter, as Spark prunes partitions only by a side that has one.
    spread = last.select("last", F.explode(F.sequence(F.date_sub("last", 2 * days), F.col("last"))).alias("dt"))
    return spread.where(F.col("dt") > F.date_sub("last", days)).select("dt")


def join_days(stored: DataFrame, days: DataFrame) -> DataFrame:
    """The rows of the joined days, a bounded set of them: other partitions of the stored table are not read."""
    return stored.join(F.broadcast(days), "dt")


def read_files(spark: SparkSession, path: str, kind: str, glob: str | None = None, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.format(kind)
    if kind == "csv":
        reader = reader.option("header", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return (reader.schema(schema) if schema else reader).load(path)


KINDS = {"parquet": "parquet", "csv": "csv", "json": "json", "jsonl": "json"}


def read_any(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """A file or folder by the extension of its name."""
    kind = KINDS.get(path.rstrip("/").rsplit(".", 1)[-1].lower())
    if kind is None:
        raise ValueError(f"no reader for {path!r}")
    return read_files(spark, path, kind, schema=schema)


def read_present(spark: SparkSession, patterns: list[str], schema: StructType) -> DataFrame:
    """The Parquet files of all patterns that match some; none at all give an empty table of the schema."""
    found = [p for p in patterns if paths.listed(spark, p)]
    return spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)


def read_numbers(spark: SparkSession, path: str, fallback: str, numbers: list[str]) -> DataFrame:
    """A CSV file with a header, from the second path where the first is missing; texts that are no numbers become nulls."""
    rows = spark.read.option("header", True).csv(path if paths.exists(spark, path) else fallback)
    return rows.withColumns({c: F.expr(f"try_cast(`{c}` AS double)") for c in numbers})


def read_window(spark: SparkSession, url: str, table: str, days: int, as_of: str, limit: int, properties: dict[str, str], empty: StructType | None = None) -> DataFrame:
    """A time window of a serving table over JDBC, filtered, ordered and limited by the database.

    With ``empty``, a database that cannot be read gives an empty table of that schema, and a warning.
    """
    if not re.fullmatch(r"\w+(\.\w+)*", table) or not re.fullmatch(r"[\d: .-]+", as_of):
        raise ValueError("not a table name or a time")
    query = f"(SELECT * FROM {table} WHERE processing_timestamp >= TIMESTAMP '{as_of}' - INTERVAL '{int(days)}' DAY ORDER BY processing_timestamp DESC LIMIT {int(limit)}) AS recent"
    try:
        return spark.read.jdbc(url, query, properties={"fetchsize": "10000", "queryTimeout": "300"} | properties)
    except Exception as error:
        if empty is None:
            raise
        warnings.warn(f"{table} cannot be read: {error}", stacklevel=2)
        return spark.createDataFrame([], empty)


def hierarchy(nested: DataFrame) -> dict[str, DataFrame]:
    """The four lookup relations of a nested province document, each with a row for "unknown"."""
    p = nested.select("id", "name", F.explode_outer("districts").alias("d"))
    provinces = nested.select(F.col("id").alias("province_id"), "name")
    districts = p.where("d is not null").select(F.col("id").alias("province_id"), F.col("d.id").alias("district_id"), F.col("d.name").alias("name"))
    out = {"provinces": provinces, "districts": districts}
    for kind, one in (("wards", "ward_id"), ("streets", "street_id")):
        items = p.where("d is not null").select(F.col("id").alias("province_id"), F.col("d.id").alias("district_id"), F.explode(f"d.{kind}").alias("x"))
        out[kind] = items.select("province_id", "district_id", F.col("x.id").alias(one), F.col("x.name").alias("name"), F.col("x.prefix").alias("prefix"))
    for kind, rows in out.items():
        unknown = rows.sparkSession.range(0, 1, 1, 1).select(*[F.lit("unknown" if c in ("name", "prefix") else "-1").cast(t).alias(c) for c, t in rows.dtypes])
        out[kind] = rows.unionByName(unknown)
    return out


def write_features(rows: DataFrame, root: str, kind: str, day: str, files: int = 10) -> tuple[str, str]:
    """Features of a day and kind of listing in few files, and a JSON document about them; returns both paths."""
    folder, plain = f"{root}/{kind}/{day.replace('-', '/')}", day.replace("-", "")
    data, about = f"{folder}/features_{kind}_{plain}.parquet", f"{folder}/metadata_{kind}_{plain}.json"
    # A shuffle, as fewer tasks for the files alone would also make the rows, joins and all, in so few tasks.
    rows.repartition(files).write.mode("overwrite").parquet(data)
    spark = rows.sparkSession
    count = spark.read.parquet(data).agg(F.count("*").alias("record_count"))
    names = F.array(*[F.lit(c) for c in rows.columns])
    made = count.select(
        F.lit(day).alias("date"), F.lit(kind).alias("property_type"), "record_count", F.lit(len(rows.columns)).alias("feature_count"), names.alias("features"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
    )
    made.coalesce(1).write.mode("overwrite").json(about)
    return data, about


def write_days(rows: DataFrame, path: str, day: str = "dt", *more: str) -> None:
    """Overwrite only the days that the rows hold."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day, *more).parquet(path)


def append_partitioned(rows: DataFrame, path: str, *columns: str) -> None:
    rows.write.mode("append").partitionBy(*columns).parquet(path)


def write_sized(rows: DataFrame, path: str, kind: str = "parquet", rows_per_file: int = 100_000, mode: str = "overwrite") -> None:
    """Files of a bounded number of rows, rebalanced by Spark to its advisory size first."""
    rows.hint("rebalance").write.mode(mode).format(kind).option("maxRecordsPerFile", rows_per_file).save(path)


def write_jdbc(rows: DataFrame, url: str, table: str, properties: dict[str, str], partitions: int = 8) -> None:
    rows.coalesce(partitions).write.mode("append").jdbc(url, table, properties={"batchsize": "1000"} | properties)


def as_message(rows: DataFrame, key: Column) -> DataFrame:
    """Key and JSON value, the shape message sinks take."""
    return rows.select(key.cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
