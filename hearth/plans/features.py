"""Cleaning, feature, split and model-bookkeeping queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators import clean, features, models, stats
from hearth.sources.adapters import listings, table, with_listings

DAY = "processing_timestamp::DATE"
SECOND = "(SELECT * FROM listings)"


def rows(spark, sf):
    return listings(spark, sf)


def _ranges_sql(ranges, optional=()) -> str:
    return " AND ".join(f"({c} IS NULL OR {c} BETWEEN {lo} AND {hi})" if c in optional else f"{c} BETWEEN {lo} AND {hi}" for c, (lo, hi) in ranges.items())


IQR = "(SELECT * FROM {0} WHERE {1} BETWEEN (SELECT quantile_cont({1}, 0.25) - 1.5 * (quantile_cont({1}, 0.75) - quantile_cont({1}, 0.25)) FROM {0}) AND (SELECT quantile_cont({1}, 0.75) + 1.5 * (quantile_cont({1}, 0.75) - quantile_cont({1}, 0.25)) FROM {0}))"


def densities(spark, sf):
    return table(spark, sf, "region").where("r_regionkey <> 3").select(F.col("r_regionkey").alias("province_id"), (F.col("r_regionkey") * 100.0 + 50).alias("population_density"))


def predictions(spark, sf):
    """A stand-in for predictions: the price moved by a share that depends on the line."""
    share = (F.conv(F.substring("id", 1, 4), 16, 10).cast("int") % 61 - 30) / 100.0
    return rows(spark, sf).select("listing_key", "price", "area", (F.col("price") * (1 + share)).alias("predicted"), "province_id")


PREDICTED = "p AS (SELECT listing_key, price, area, province_id, price * (1 + (('0x' || substr(id, 1, 4))::INT % 61 - 30) / 100.0::DOUBLE) AS predicted FROM listings)"
ERRORS = "e AS (SELECT *, abs(price - predicted) / abs(price) AS rel FROM p)"
METRICS = "count(*) AS n, round(avg(CASE WHEN rel <= 0.1::DOUBLE THEN 1.0 ELSE 0 END) * 100, 4) AS within_10, round(avg(CASE WHEN rel <= 0.2::DOUBLE THEN 1.0 ELSE 0 END) * 100, 4) AS within_20, round(avg(CASE WHEN rel <= 0.3::DOUBLE THEN 1.0 ELSE 0 END) * 100, 4) AS within_30, round(quantile_cont(rel, 0.5) * 100, 4) AS median_error, round(avg(rel) * 100, 4) AS mape, round(sqrt(avg(pow(price - predicted, 2))))::BIGINT AS rmse, round(avg(abs(price - predicted)))::BIGINT AS mae, round(1 - sum(pow(price - predicted, 2)) / (var_pop(price) * count(*)), 6) AS r2"


def by_model(spark, sf):
    named = predictions(spark, sf).withColumn("model", F.concat(F.lit("m"), F.col("province_id")))
    return stats.price_errors(named, "price", "predicted", "model")


BY_MODEL = f"{PREDICTED}, {ERRORS}, m AS (SELECT 'm' || province_id AS model, {METRICS} FROM e GROUP BY province_id)"


def window_scan(spark, sf):
    day = F.to_date("processing_timestamp")
    end = F.lit("1997-03-01").cast("date")
    return rows(spark, sf).where(day.between(F.date_sub(end, 59), end)).groupBy(day.cast("string").alias("day")).agg(F.count("*").alias("n"), stats.whole("price").alias("avg_price"))


def latest_partition(spark, sf):
    r = rows(spark, sf).withColumn("day", F.to_date("processing_timestamp")).where(F.col("day").between(F.lit("1997-01-01").cast("date"), F.lit("1997-03-31").cast("date")))
    last = r.agg(F.max("day").alias("day"))
    return r.join(F.broadcast(last), "day").select(F.col("day").cast("string").alias("day"), "listing_key")


def balanced(listed):
    return clean.balanced(listed, "province").groupBy("province").agg(F.count("*").alias("n"), F.min("listing_key").alias("first"))


BALANCED = "c AS (SELECT province, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, province) AS k, lead(count(*)) OVER (ORDER BY count(*) DESC, province) AS second FROM f GROUP BY province), r AS (SELECT f.*, row_number() OVER (PARTITION BY province ORDER BY md5(listing_key), listing_key) AS k FROM f) SELECT r.province, count(*) AS n, min(r.listing_key) AS first FROM r JOIN c ON c.province = r.province WHERE r.k <= CASE WHEN c.k = 1 THEN floor(coalesce(c.second, c.n) * 1.2::DOUBLE) ELSE c.n END GROUP BY r.province"


PLANS = {
    "critical_filter": (
        lambda s, d: rows(s, d).where(clean.in_ranges(clean.CRITICAL | {"floor_count": (1, 99)}, ("floor_count",))).select("listing_key", "price"),
        with_listings(f"SELECT listing_key, price FROM listings WHERE {_ranges_sql(clean.CRITICAL | {'floor_count': (1, 99)}, ('floor_count',))}"),
    ),
    "configured_filter": (
        lambda s, d: rows(s, d).where(clean.in_ranges(clean.CONFIGURED, ("floor_count",))).agg(F.count("*").alias("n"), F.round(F.sum("area")).cast("long").alias("area")),
        with_listings(f"SELECT count(*) AS n, round(sum(area))::BIGINT AS area FROM listings WHERE {_ranges_sql(clean.CONFIGURED, ('floor_count',))}"),
    ),
    "impute": (
        lambda s, d: clean.impute(rows(s, d), ["bedroom", "bathroom"], ["floor_count"], ["title"], ["price"]).select("listing_key", "bedroom", "bathroom", "floor_count", "title"),
        with_listings("SELECT listing_key, coalesce(bedroom::DOUBLE, (SELECT quantile_cont(bedroom, 0.5) FROM listings)) AS bedroom, coalesce(bathroom::DOUBLE, (SELECT quantile_cont(bathroom, 0.5) FROM listings)) AS bathroom, coalesce(floor_count, -1) AS floor_count, coalesce(title, 'unknown') AS title FROM listings WHERE price IS NOT NULL"),
    ),
    "outliers_iqr": (
        lambda s, d: clean.without_outliers(rows(s, d), "iqr", ["price_per_m2", "area"]).agg(F.count("*").alias("n"), stats.whole("price").alias("avg_price")),
        with_listings(f"SELECT count(*) AS n, round(avg(price))::BIGINT AS avg_price FROM {IQR.format(IQR.format('listings', 'price_per_m2'), 'area')}"),
    ),
    "outliers_z": (
        lambda s, d: clean.without_outliers(rows(s, d), "zscore", ["price_per_m2"]).agg(F.count("*").alias("n"), stats.whole("price").alias("avg_price")),
        with_listings("z AS (SELECT avg(price_per_m2) AS m, stddev_samp(price_per_m2) AS s FROM listings) SELECT count(*) AS n, round(avg(price))::BIGINT AS avg_price FROM listings, z WHERE abs(price_per_m2 - m) <= 3 * s"),
    ),
    "room_features": (
        lambda s, d: features.rooms(rows(s, d)).select("listing_key", "total_rooms", F.round("area_per_room", 4).alias("area_per_room"), F.round("bedroom_bathroom_ratio", 4).alias("ratio")),
        with_listings("SELECT listing_key, bedroom + bathroom AS total_rooms, round(area / nullif(bedroom + bathroom, 0), 4) AS area_per_room, round(bedroom::DOUBLE / nullif(bathroom, 0), 4) AS ratio FROM listings"),
    ),
    "density_join": (
        lambda s, d: features.density(rows(s, d), densities(s, d)).groupBy("province_id").agg(F.count("*").alias("n"), F.max("population_density").alias("density")),
        with_listings("SELECT province_id, count(*) AS n, CASE WHEN province_id <> 3 THEN province_id * 100.0::DOUBLE + 50 ELSE 0 END AS density FROM listings GROUP BY province_id"),
    ),
    "serving_features": (
        lambda s, d: features.served(rows(s, d), {"bedroom": 2.0, "bathroom": 1.0, "floor_count": 1.0}).select("listing_key", "total_rooms", F.round("area_per_room", 4).alias("area_per_room"), F.round("bedroom_bathroom_ratio", 4).alias("ratio")),
        with_listings("f AS (SELECT listing_key, area, coalesce(bedroom::DOUBLE, 2) AS b, coalesce(bathroom::DOUBLE, 1) AS t FROM listings) SELECT listing_key, b + t AS total_rooms, round(area / greatest(b + t, 1), 4) AS area_per_room, round(b / greatest(t, 1), 4) AS ratio FROM f"),
    ),
    "temporal_features": (
        lambda s, d: table(s, d, "orders").select("o_orderkey", *[c.alias(n) for n, c in features.calendar(F.col("o_orderdate")).items()]),
        "SELECT o_orderkey, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, day(o_orderdate)::INT AS day, quarter(o_orderdate)::INT AS quarter, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season, datediff('day', DATE '1970-01-01', o_orderdate::DATE)::INT AS days FROM orders",
    ),
    "interaction_features": (
        lambda s, d: rows(s, d).withColumns(features.interactions()).select("listing_key", F.round("price_per_area", 2).alias("ppa"), F.round("log_price", 8).alias("log_price"), "area_squared", features.tier(F.col("province"), ("ASIA",), ("EUROPE", "AMERICA")).alias("tier"), features.plausible(F.col("price")).alias("plausible")),
        with_listings("SELECT listing_key, round(price / area, 2) AS ppa, round(ln(price), 8) AS log_price, pow(area, 2) AS area_squared, CASE WHEN province = 'ASIA' THEN 1 WHEN province IN ('EUROPE', 'AMERICA') THEN 2 ELSE 3 END AS tier, CASE WHEN price < 1e8 THEN 'too_low' WHEN price > 5e10 THEN 'too_high' ELSE 'ok' END AS plausible FROM listings"),
    ),
    "fallback_price": (
        lambda s, d: rows(s, d).select("listing_key", F.round(features.fallback_price(F.col("area"), F.col("province_id"), F.col("bedroom"), F.col("bathroom"), {1: 8e7, 2: 6e7}, 3e7)).cast("long").alias("estimate")),
        with_listings("SELECT listing_key, round(area * CASE province_id WHEN 1 THEN 8e7 WHEN 2 THEN 6e7 ELSE 3e7 END * (1 + 0.05::DOUBLE * coalesce(bedroom, 0) + 0.03::DOUBLE * coalesce(bathroom, 0)))::BIGINT AS estimate FROM listings"),
    ),
    "window_scan": (
        window_scan,
        with_listings(f"SELECT ({DAY})::VARCHAR AS day, count(*) AS n, round(avg(price))::BIGINT AS avg_price FROM listings WHERE {DAY} BETWEEN DATE '1997-03-01' - 59 AND DATE '1997-03-01' GROUP BY 1"),
    ),
    "latest_partition": (
        latest_partition,
        with_listings(f"r AS (SELECT {DAY} AS day, listing_key FROM listings WHERE {DAY} BETWEEN DATE '1997-01-01' AND DATE '1997-03-31') SELECT day::VARCHAR AS day, listing_key FROM r WHERE day = (SELECT max(day) FROM r)"),
    ),
    "temporal_split": (
        lambda s, d: clean.earliest(rows(s, d), 0.8).groupBy("train").agg(F.count("*").alias("n"), F.max(F.to_date("posted_date").cast("string")).alias("last"), F.min(F.to_date("posted_date").cast("string")).alias("first")),
        with_listings("r AS (SELECT posted_date::DATE AS day, row_number() OVER (ORDER BY posted_date::DATE, listing_key) <= floor((SELECT count(*) FROM listings) * 0.8::DOUBLE) AS train FROM listings) SELECT train, count(*) AS n, max(day)::VARCHAR AS last, min(day)::VARCHAR AS first FROM r GROUP BY train"),
    ),
    "hash_split": (
        lambda s, d: rows(s, d).groupBy(clean.hash_split(F.col("listing_key"), 80).alias("train")).agg(F.count("*").alias("n")),
        with_listings("SELECT ('0x' || substr(md5(listing_key), 1, 7))::INT % 100 < 80 AS train, count(*) AS n FROM listings GROUP BY 1"),
    ),
    "balance": (lambda s, d: balanced(rows(s, d)), with_listings(f"f AS (SELECT * FROM listings), {BALANCED}")),
    "unknown_to_null": (
        lambda s, d: features.null_if_unknown(rows(s, d).select("listing_key", F.coalesce("bedroom", F.lit(-1)).alias("bedroom")), ["bedroom"]).agg(F.count("*").alias("n"), F.count("bedroom").alias("known")),
        with_listings("SELECT count(*) AS n, count(bedroom) AS known FROM listings"),
    ),
    "error_metrics": (lambda s, d: stats.price_errors(predictions(s, d), "price", "predicted"), with_listings(f"{PREDICTED}, {ERRORS} SELECT {METRICS} FROM e")),
    "band_errors": (
        lambda s, d: stats.band_errors(predictions(s, d), "price", "predicted", (1e9, 3e9, 1e10)),
        with_listings(f"{PREDICTED} SELECT CASE WHEN price >= 1e10 THEN 3 WHEN price >= 3e9 THEN 2 WHEN price >= 1e9 THEN 1 ELSE 0 END AS band, count(*) AS n, round(avg(abs(price - predicted)))::BIGINT AS mae FROM p GROUP BY 1 HAVING count(*) > 10"),
    ),
    "quality_gate": (
        lambda s, d: models.gate(by_model(s, d)).select("model", "r2_ok", "mape_ok", "within_ok", "score", "passed"),
        with_listings(f"{BY_MODEL} SELECT model, r2 >= 0.7 AS r2_ok, mape <= 30 AS mape_ok, within_20 >= 60 AS within_ok, round(((r2 >= 0.7)::INT + (mape <= 30)::INT + (within_20 >= 60)::INT) / 3.0::DOUBLE, 4) AS score, r2 >= 0.7 AND mape <= 30 AND within_20 >= 60 AS passed FROM m"),
    ),
    "ensemble_weights": (
        lambda s, d: models.ensemble_weights(by_model(s, d)),
        with_listings(f"{BY_MODEL}, r AS (SELECT model, r2, row_number() OVER (ORDER BY round(r2 * 0.7::DOUBLE + within_20 / 100 * 0.3::DOUBLE, 9) DESC, model) AS place FROM m) SELECT model, place, round(r2 / sum(r2) OVER (), 6) AS weight FROM r WHERE place <= 3"),
    ),
    "best_model": (lambda s, d: models.best_model(by_model(s, d)), with_listings(f"{BY_MODEL} SELECT model, round(r2, 6) AS r2 FROM m ORDER BY r2 DESC, model DESC LIMIT 1")),
    "nearest_model_date": (
        lambda s, d: models.nearest_day(rows(s, d).select(F.to_date("posted_date").alias("day")).distinct().where("dayofmonth(day) = 10"), "1996-05-14").select(F.col("day").cast("string").alias("day"), "gap"),
        with_listings("SELECT d::VARCHAR AS day, abs(datediff('day', d, DATE '1996-05-14'))::INT AS gap FROM (SELECT DISTINCT posted_date::DATE AS d FROM listings) WHERE day(d) = 10 AND abs(datediff('day', d, DATE '1996-05-14')) <= 7 ORDER BY gap, d LIMIT 1"),
    ),
    "available_dates": (
        lambda s, d: rows(s, d).select(F.to_date("posted_date").cast("string").alias("day")).distinct(),
        with_listings("SELECT DISTINCT (posted_date::DATE)::VARCHAR AS day FROM listings"),
    ),
    "checkpoint_latest": (
        lambda s, d: table(s, d, "events").groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"), F.count("*").alias("n")).select("user_id", "last_type", "n"),
        "SELECT user_id, event_type AS last_type, n FROM (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1",
    ),
    "checkpoint_stats": (
        lambda s, d: table(s, d, "events").agg(F.count("*").alias("total"), F.count_if(F.col("value") > 50).alias("success"), F.count_if(~(F.col("value") > 50)).alias("failed")),
        "SELECT count(*) AS total, count(*) FILTER (value > 50) AS success, count(*) FILTER (NOT value > 50) AS failed FROM events",
    ),
    "mode_fill": (
        lambda s, d: rows(s, d).groupBy("province", "house_type").agg(F.count("*").alias("n")).groupBy("province").agg(F.min_by("house_type", F.struct(-F.col("n"), "house_type")).alias("mode")),
        with_listings("SELECT province, house_type AS mode FROM (SELECT province, house_type, row_number() OVER (PARTITION BY province ORDER BY n DESC, house_type) AS k FROM (SELECT province, house_type, count(*) AS n FROM listings GROUP BY ALL)) WHERE k = 1"),
    ),
}
