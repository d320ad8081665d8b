"""Prediction, feature-store, evaluation and legacy duplicate queries, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators import clean, dedup, features, models, stats
from hearth.plans.dedup import _half_up
from hearth.plans.features import BY_MODEL, PREDICTED, by_model, densities, predictions, rows
from hearth.plans.streams import _work
from hearth.sources import tables
from hearth.sources.adapters import with_listings
from hearth.sources.tables import stored

BANDS = (("budget", 0.0, 3e9), ("mid_range", 3e9, 1e10), ("luxury", 1e10, 3e10), ("ultra_luxury", 3e10, None))
BAND_SQL = "CASE WHEN price >= 3e10 THEN 'ultra_luxury' WHEN price >= 1e10 THEN 'luxury' WHEN price >= 3e9 THEN 'mid_range' WHEN price >= 0 THEN 'budget' END"
DAY_OF = "1996-05-14"


def voices(spark, sf):
    """Three stand-ins for models, of which each is silent for some rows."""
    part = F.col("province_id") * 7 + F.length("listing_key")
    p = predictions(spark, sf).withColumns({"a": F.when(part % 5 != 0, F.col("predicted")), "b": F.when(part % 3 != 0, F.col("price") * 1.1), "c": F.when(part % 2 != 0, F.col("price") * 0.9)})
    found = models.ensemble_mean(p, ["a", "b", "c"])
    return found.groupBy("province_id", "voices").agg(F.count("*").alias("n"), F.round(F.avg("predicted_mean")).cast("long").alias("mean"))


VOICES_SQL = f"""{PREDICTED}, q AS (SELECT *, province_id * 7 + length(listing_key) AS part FROM p),
v AS (SELECT province_id, CASE WHEN part % 5 <> 0 THEN predicted END AS a, CASE WHEN part % 3 <> 0 THEN price * 1.1::DOUBLE END AS b, CASE WHEN part % 2 <> 0 THEN price * 0.9::DOUBLE END AS c FROM q),
w AS (SELECT province_id, (a IS NOT NULL)::INT + (b IS NOT NULL)::INT + (c IS NOT NULL)::INT AS voices, coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) AS total FROM v)
SELECT province_id, voices, count(*) AS n, round(avg(total / nullif(voices, 0)))::BIGINT AS mean FROM w GROUP BY ALL"""


def registry(spark, sf):
    """A registry written entry by entry and read back: its best and its latest model."""
    path = f"{_work(spark)}/registry"
    for i, r in enumerate(by_model(spark, sf).orderBy("model").collect()):  # at most one row a province
        models.register(spark, path, r["model"], {"r2": r["r2"], "rmse": r["rmse"]}, f"models/{r['model']}", f"1997-01-{10 + (i * 7) % 5:02d}")
    entries = models.registered(spark, path)
    kinds = (("best", models.best_registered), ("latest", models.latest_registered))
    return kinds_of(entries, kinds)


def kinds_of(entries, kinds):
    parts = [pick(entries).select(F.lit(kind).alias("kind"), "model", "day", F.round("r2", 6).alias("r2")) for kind, pick in kinds]
    return parts[0].unionByName(parts[1])


REGISTRY_SQL = f"""{BY_MODEL}, g AS (SELECT model, r2, '1997-01-' || (10 + ((row_number() OVER (ORDER BY model) - 1) * 7) % 5) AS day FROM m)
SELECT * FROM (SELECT 'best' AS kind, model, day, round(r2, 6) AS r2 FROM g ORDER BY r2 DESC, day DESC, model LIMIT 1)
UNION ALL SELECT * FROM (SELECT 'latest', model, day, round(r2, 6) FROM g ORDER BY day DESC, r2 DESC, model LIMIT 1)"""


def coded(spark, sf):
    """Listings with the codes and derived columns of the feature store; every seventh has no direction."""
    r = features.density(features.rooms(rows(spark, sf)), densities(spark, sf))
    spot = F.col("district_id") + F.length("listing_key")
    return r.withColumns(
        {"house_direction_code": F.when(spot % 7 != 0, spot % 8), "legal_status_code": spot % 5, "interior_code": F.when(spot % 4 != 0, spot % 3), "ward_id": F.nullif(spot % 11, F.lit(0))}
    )


CODED = "c AS (SELECT *, CASE WHEN spot % 7 <> 0 THEN spot % 8 END AS house_direction_code, spot % 5 AS legal_status_code, CASE WHEN spot % 4 <> 0 THEN spot % 3 END AS interior_code, nullif(spot % 11, 0) AS ward_id FROM (SELECT *, district_id + length(listing_key) AS spot FROM listings))"
FULL = f"""{CODED}, med AS (SELECT quantile_cont(bedroom, 0.5) AS b, quantile_cont(bathroom, 0.5) AS t, quantile_cont(floor_count, 0.5) AS f FROM c),
t AS (SELECT c.* EXCLUDE (bedroom, bathroom, floor_count), coalesce(c.bedroom::DOUBLE, med.b) AS bedroom, coalesce(c.bathroom::DOUBLE, med.t) AS bathroom, coalesce(c.floor_count::DOUBLE, med.f) AS floor_count FROM c, med)"""


def feature_store(spark, sf):
    """The features of a day written with their metadata, both read back."""
    data, about = tables.write_features(features.stored(coded(spark, sf)), f"{_work(spark)}/store", "house", DAY_OF)
    found = spark.read.parquet(data).agg(F.count("*").alias("n"), F.count("house_direction_code").alias("directed"), F.sum("ward_id").alias("wards"))
    return found.join(spark.read.json(about).select("date", "property_type", "record_count", "feature_count", F.array_join("features", ",").alias("features")))


STORED_SQL = ",".join((*features.STORED, "id"))


def tree_ready(spark, sf):
    r = features.for_trees(stored(coded(spark, sf).select("listing_key", *features.STORED)))
    return r.select("listing_key", "house_direction_code", "interior_code", "ward_id", "bedroom", "floor_count", F.round("area_per_room", 6).alias("area_per_room"), F.round("bedroom_bathroom_ratio", 6).alias("ratio"))


def line_ready(spark, sf):
    r = features.for_lines(stored(coded(spark, sf).select("listing_key", *features.STORED)))
    return r.select("listing_key", F.round("log_price", 8).alias("log_price"), "house_direction_code", "interior_code", "legal_status_code", "bathroom", F.round("total_rooms", 6).alias("total_rooms"))


def mode_ready(spark, sf):
    r = features.modes(coded(spark, sf), ("house_direction_code", "interior_code"))
    return r.groupBy("house_direction_code", "interior_code").agg(F.count("*").alias("n"))


MODE = "(SELECT {0} FROM c WHERE {0} IS NOT NULL GROUP BY {0} ORDER BY count(*) DESC, {0} LIMIT 1)"


def temporal_validation(spark, sf):
    marked = clean.earliest(rows(spark, sf), 18 / 24)
    day = F.date_format("posted_date", "yyyy-MM-dd")
    return marked.groupBy(F.when(F.col("train"), "train").otherwise("test").alias("part")).agg(F.count("*").alias("n"), F.min(day).alias("first"), F.max(day).alias("last"))


def recrawled(spark, sf):
    """Listings seen twice, the second time with another price for some: one row an id, the fullest, then the newest.

    Listings are dealt out by the bytes of their id once; the second sighting is made where the first one lies.
    """
    r = rows(spark, sf).select(F.unhex("id").alias("key"), "price", "bedroom", "bathroom", "processing_timestamp").repartition("key")
    seen = F.struct("price", "processing_timestamp")
    again = F.struct((F.col("price") + 1000).alias("price"), (F.col("processing_timestamp") + F.expr("interval 2 days")).alias("processing_timestamp"))
    both = r.select("key", "bedroom", "bathroom", F.inline(F.when(F.col("bedroom").isNotNull(), F.array(seen, again)).otherwise(F.array(seen))))
    score = F.col("bedroom").isNotNull().cast("int") + F.col("bathroom").isNotNull().cast("int")
    return dedup.best_of(both, ["key"], score.desc(), F.desc("processing_timestamp"), F.asc("price")).select(F.lower(F.hex("key")).alias("id"), "price")


def graded_pairs(spark, sf):
    """Likeness of the listings of one order."""
    need = ["listing_key", "url", "province", "district", "ward", "street", "price", "area", "bedroom", "bathroom", "latitude", "longitude"]
    x, y = rows(spark, sf).select(*need).alias("x"), rows(spark, sf).select(*need).alias("y")
    pairs = x.join(y, (F.col("x.url") == F.col("y.url")) & (F.col("x.listing_key") < F.col("y.listing_key")))
    return pairs.select(F.col("x.listing_key").alias("a"), F.col("y.listing_key").alias("b"), F.round(dedup.graded("x", "y"), 4).alias("likeness"))


_METRES = "2 * 6371000.0::DOUBLE * asin(sqrt(least(1.0, pow(sin(radians(y.latitude - x.latitude) / 2), 2) + cos(radians(x.latitude)) * cos(radians(y.latitude)) * pow(sin(radians(y.longitude - x.longitude) / 2), 2))))"
_SAME = lambda names: "(" + " AND ".join(f"x.{c} IS NOT DISTINCT FROM y.{c}" for c in names) + ")::INT"
_FALL = lambda c, k: f"greatest(0.0::DOUBLE, 1 - abs(x.{c} - y.{c}) / greatest(x.{c}, y.{c}) * {k})"
GRADED_SQL = f"""SELECT x.listing_key AS a, y.listing_key AS b, round({_SAME(("province", "district", "ward", "street"))} * 0.3::DOUBLE + {_FALL("price", 2)} * 0.25::DOUBLE + {_FALL("area", 5)} * 0.2::DOUBLE
  + {_SAME(("bedroom", "bathroom"))} * 0.15::DOUBLE + CASE WHEN {_METRES} < 50 THEN 1.0::DOUBLE ELSE greatest(0.0::DOUBLE, 1 - {_METRES} / 1000) END * 0.1::DOUBLE, 4) AS likeness
FROM listings x JOIN listings y ON x.url = y.url AND x.listing_key < y.listing_key"""


PLANS = {
    "ensemble_mean": (voices, with_listings(VOICES_SQL)),
    "model_registry": (registry, with_listings(REGISTRY_SQL)),
    "feature_store": (
        feature_store,
        with_listings(f"{CODED} SELECT count(*) AS n, count(house_direction_code) AS directed, sum(ward_id)::BIGINT AS wards, '{DAY_OF}' AS date, 'house' AS property_type, count(*) AS record_count, {len(features.STORED) + 1} AS feature_count, '{STORED_SQL}' AS features FROM c"),
    ),
    "tree_features": (
        tree_ready,
        with_listings(f"{FULL} SELECT listing_key, coalesce(house_direction_code, -1) AS house_direction_code, coalesce(interior_code, -1) AS interior_code, coalesce(ward_id, -1) AS ward_id, bedroom, floor_count, round(area / (bedroom + bathroom + 1e-5), 6) AS area_per_room, round(bedroom / (bathroom + 1e-5), 6) AS ratio FROM t"),
    ),
    "line_features": (
        line_ready,
        with_listings(f"{FULL} SELECT listing_key, round(ln(price), 8) AS log_price, coalesce(house_direction_code::VARCHAR, 'missing') AS house_direction_code, coalesce(interior_code::VARCHAR, 'missing') AS interior_code, legal_status_code::VARCHAR AS legal_status_code, bathroom, round(bedroom + bathroom, 6) AS total_rooms FROM t"),
    ),
    "mode_features": (
        mode_ready,
        with_listings(f"{CODED} SELECT coalesce(house_direction_code, {MODE.format('house_direction_code')}) AS house_direction_code, coalesce(interior_code, {MODE.format('interior_code')}) AS interior_code, count(*) AS n FROM c GROUP BY 1, 2"),
    ),
    "error_spread": (
        lambda s, d: stats.error_spread(predictions(s, d), "price", "predicted"),
        with_listings(f"{PREDICTED}, e AS (SELECT abs(price - predicted) AS e FROM p), k AS (SELECT quantile_cont(e, 0.95) AS p95 FROM e) SELECT count(*) AS n, round(avg(pow(e, 2)) / 1e12)::BIGINT AS mse_1e12, round(max(e))::BIGINT AS max_error, round(min(e))::BIGINT AS min_error, round(stddev_pop(e))::BIGINT AS std_error, round(quantile_cont(e, 0.5))::BIGINT AS median_abs_error, count(*) FILTER (e > p95) AS outliers, round(avg((e > p95)::INT) * 100, 4) AS outliers_pct FROM e, k"),
    ),
    "band_profile": (
        lambda s, d: stats.band_profile(predictions(s, d), "price", "predicted", BANDS),
        with_listings(f"{PREDICTED} SELECT {BAND_SQL} AS band, count(*) AS n, round(avg(abs(price - predicted)))::BIGINT AS mae, round(avg(abs(price - predicted) / price), 6) AS mape FROM p GROUP BY 1"),
    ),
    "temporal_validation": (
        temporal_validation,
        with_listings("r AS (SELECT posted_date::DATE AS day, row_number() OVER (ORDER BY posted_date::DATE, listing_key) <= floor((SELECT count(*) FROM listings) * 0.75::DOUBLE) AS train FROM listings) SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS part, count(*) AS n, min(day)::VARCHAR AS first, max(day)::VARCHAR AS last FROM r GROUP BY 1"),
    ),
    "dedup_recrawled": (
        recrawled,
        with_listings("u AS (SELECT id, price, bedroom, bathroom, processing_timestamp AS seen FROM listings UNION ALL SELECT id, price + 1000, bedroom, bathroom, processing_timestamp + INTERVAL 2 DAY FROM listings WHERE bedroom IS NOT NULL) SELECT id, price FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY (bedroom IS NOT NULL)::INT + (bathroom IS NOT NULL)::INT DESC, seen DESC, price) = 1"),
    ),
    "graded_pairs": (graded_pairs, with_listings(GRADED_SQL)),
    "plain_fingerprint": (
        lambda s, d: rows(s, d).select("listing_key", dedup.plain_key(F.concat(F.lit(" Nhà số 5, "), "street", F.lit("! (Quận Đống Đa)"))).alias("fingerprint")),
        with_listings(f"SELECT listing_key, md5(concat_ws('|', lower(trim(regexp_replace(' Nhà số 5, ' || street || '! (Quận Đống Đa)', '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'))), {_half_up('price / 1e8')} * 100000000, {_half_up('area')}, coalesce(bedroom, 0), coalesce(bathroom, 0), province, district, ward)) AS fingerprint FROM listings"),
    ),
}
