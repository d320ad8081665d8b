"""Streaming queries over ``events``, held against the same result in batch SQL; models are checked by their rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators import clean, features, models, stats
from hearth.plans.features import densities
from hearth.sources import tables
from hearth.sources.adapters import listings, with_listings
from hearth.streaming import ingest


_work = tables.work_path


def _events(spark, sf):
    return ingest.read_parquet(spark, f"{sf}/events.parquet*").withColumn("at", F.col("ts").cast("timestamp"))


def stream_parity(spark, sf):
    work = _work(spark)
    rows = _events(spark, sf).select("event_id", "user_id", "event_type", "value", F.date_format("at", "yyyy-MM-dd").alias("day"))
    stored = ingest.run_once(rows, f"{work}/out", f"{work}/checkpoint", ["event_type", "day"])
    return stored.groupBy("event_type", "day").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


def _counted(spark, counted):
    """All windows of a drained stream, as a table."""
    work = _work(spark)

    def keep(batch, number):
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{work}/out/batch={number}")

    query = counted.writeStream.outputMode("complete").option("checkpointLocation", f"{work}/checkpoint").trigger(availableNow=True).foreachBatch(keep).start()
    query.awaitTermination()
    rows = spark.read.parquet(f"{work}/out/*")
    return rows.where(F.col("batch") == rows.agg(F.max("batch")).first()[0]).drop("batch")


def stream_windows(spark, sf):
    counted = ingest.by_window(_events(spark, sf), "at", "1 day", "3650 days", "event_type")
    return _counted(spark, counted).select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def stream_distinct(spark, sf):
    work = _work(spark)
    rows = ingest.once_per_key(_events(spark, sf), ["user_id", "event_type"], "at", "3650 days").select("user_id", "event_type")
    stored = ingest.run_once(rows, f"{work}/out", f"{work}/checkpoint", ["event_type"])
    return stored.groupBy("event_type").agg(F.count("*").alias("users"))


def stream_expiry(spark, sf):
    """Clicks by day and kind as they arrive, by halves of months: six hours after its end a day is final, dropped from the state and closed to later rows."""
    clicks = spark.read.parquet(f"{sf}/clicks.parquet").where("ts is not null and arrived_at is not null")
    half = F.concat_ws(" ", F.date_format("arrived_at", "yyyy-MM"), F.when(F.dayofmonth("arrived_at") > 15, "b").otherwise("a"))
    rows = clicks.select(F.col("ts").cast("timestamp").alias("at"), "kind", half.alias("half"))
    stored = ingest.drained_by_part(rows, "half", _work(spark), lambda r: ingest.by_window(r, "at", "1 day", "6 hours", "kind"), ["kind"])
    return stored.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "kind", "n")


def store_days(spark, sf):
    """All listings written by day, the days of one month overwritten, a pruned window read back."""
    path = f"{_work(spark)}/days"
    rows = listings(spark, sf).select("listing_key", "price", F.date_format("posted_date", "yyyy-MM-dd").alias("dt"))
    tables.write_days(rows.repartition("dt"), path)
    tables.write_days(rows.where("dt between '1996-03-01' and '1996-03-31'").withColumn("price", F.lit(1.0)).repartition("dt"), path)
    back = tables.read_days(spark, path, "1996-06-30", 151)
    return back.groupBy(F.date_format(F.col("dt"), "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.round(F.sum("price")).cast("long").alias("total"))


def priced(spark, sf, *more):
    rows = features.density(features.rooms(listings(spark, sf)), densities(spark, sf)).where("price > 0").na.drop(subset=["bedroom", "bathroom", "floor_count"])
    rows = rows.withColumns({"log_price": F.log("price"), "train": clean.hash_split(F.col("listing_key"), 80)})
    return rows.select("listing_key", "price", "log_price", "train", "house_type", *features.FEATURES, *more)


def _evaluated(spark, sf, pipeline, back=lambda c: c):
    rows = priced(spark, sf).cache()
    try:
        train = rows.where("train")
        model = pipeline.fit(models.dealt(train, train.count(), "listing_key"))
        scored = model.transform(rows.where("not train")).withColumn("predicted", back(F.col("prediction")))
        found = stats.price_errors(scored, "price", "predicted").collect()
    finally:
        rows.unpersist()
    schema = "n long, within_10 double, within_20 double, within_30 double, median_error double, mape double, rmse long, mae long, r2 double"
    return spark.createDataFrame([tuple(r) for r in found], schema)


PLANS = {
    "stream_parity": (stream_parity, "SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL"),
    "stream_windows": (stream_windows, "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL"),
    "stream_distinct": (stream_distinct, "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type"),
    "stream_expiry": (
        stream_expiry,
        """WITH r AS (SELECT date_trunc('day', ts) AS d, ts, kind, strftime(arrived_at, '%Y-%m') || CASE WHEN day(arrived_at) > 15 THEN ' b' ELSE ' a' END AS half
           FROM clicks WHERE ts IS NOT NULL AND arrived_at IS NOT NULL),
        seen AS (SELECT half, max(max(ts)) OVER (ORDER BY half ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 6 HOUR AS closed FROM r GROUP BY half),
        final AS (SELECT max(ts) - INTERVAL 6 HOUR AS closed FROM r)
        SELECT strftime(d, '%Y-%m-%d') AS day, kind, count(*) AS n FROM r JOIN seen USING (half)
        WHERE (seen.closed IS NULL OR d + INTERVAL 1 DAY > seen.closed) AND d + INTERVAL 1 DAY <= (SELECT closed FROM final) GROUP BY ALL""",
    ),
    "store_days": (
        store_days,
        with_listings("SELECT strftime(posted_date, '%Y-%m') AS month, count(*) AS n, round(sum(CASE WHEN strftime(posted_date, '%Y-%m') = '1996-03' THEN 1.0::DOUBLE ELSE price END))::BIGINT AS total FROM listings WHERE strftime(posted_date, '%Y-%m') BETWEEN '1996-02' AND '1996-06' GROUP BY 1"),
    ),
    "train_forest": (lambda s, d: _evaluated(s, d, models.forest(features.FEATURES)), None),
    "train_boosted": (lambda s, d: _evaluated(s, d, models.boosted(features.FEATURES)), None),
    "train_linear": (lambda s, d: _evaluated(s, d, models.linear(features.FEATURES, ["house_type"]), F.exp), None),
}
