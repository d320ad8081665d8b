"""Models by day in service, searches over folds of days, final checks and newest rows, and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.config import ModelConfig
from hearth.operators import clean, dedup, features, folds, models, quantiles, serving
from hearth.plans.stored import FOLDS_SQL
from hearth.plans.streams import _work
from hearth.sources.adapters import listings, with_listings
from hearth.sources.tables import stored

LINES = ("area_per_room", "total_rooms")
DAYS = ("1996-06-30", "1997-06-30")
CONFIG = ModelConfig(models=LINES, outlier_method="zscore", least_rows=500, balance_cap=1e9)


NEEDED = ["listing_key", "province", "province_id", "price", "price_per_m2", "area", "bedroom", "bathroom", "posted_date", "house_type"]


def _rows(spark, sf):
    """What training and service read of the listings, stored, as every model and every bound reads them again."""
    return stored(features.rooms(listings(spark, sf).select(*NEEDED)))


def _service(spark, sf, rows):
    store = f"{_work(spark)}/store"
    for day in DAYS:
        serving.train_day(rows, CONFIG, store, day)
    return serving.Service(spark, store, CONFIG)


def served_prices(spark, sf):
    """All listings priced by the models of the day nearest to a wanted one; where rooms are unknown, guessed."""
    rows = _rows(spark, sf)
    found = _service(spark, sf, rows).load("1997-06-20").predict(rows)
    return found.groupBy("province", "origin", "voices").agg(F.count("*").alias("n"), F.round(F.avg("predicted_price") / 1000).cast("long").alias("thousands"))


def model_days(spark, sf):
    """Every registered model with its error, and whether it is the one in service for a day."""
    service = _service(spark, sf, _rows(spark, sf)).load("1996-07-15")
    entries = models.registered(spark, f"{service.store}/registry")
    return entries.select("day", "model", F.round("r2", 5).alias("r2"), (F.col("day") == service.day).alias("in_service"))


MODELS_SQL = """days AS (SELECT unnest([DATE '1996-06-30', DATE '1997-06-30']) AS d),
t AS (SELECT *, posted_date::DATE AS day, bedroom + bathroom AS total_rooms, area / nullif(bedroom + bathroom, 0) AS area_per_room FROM listings),
z AS (SELECT d, t.*, day <= (d - INTERVAL 6 MONTH)::DATE AS train FROM t JOIN days ON day > (d - INTERVAL 24 MONTH)::DATE AND day <= d),
b AS (SELECT d, avg(price_per_m2) AS m, stddev_samp(price_per_m2) AS s FROM z WHERE train GROUP BY d),
k AS (SELECT z.* FROM z JOIN b USING (d) WHERE train AND price_per_m2 BETWEEN m - 3 * s AND m + 3 * s AND total_rooms IS NOT NULL),
f AS (SELECT d, regr_slope(price, area_per_room) AS s1, regr_intercept(price, area_per_room) AS i1, regr_slope(price, total_rooms) AS s2, regr_intercept(price, total_rooms) AS i2 FROM k GROUP BY d)"""
SERVED_SQL = f"""{MODELS_SQL}, p AS (SELECT province, CASE WHEN total_rooms IS NULL THEN 'guess' ELSE 'models' END AS origin, CASE WHEN total_rooms IS NULL THEN 0 ELSE 2 END AS voices,
  CASE WHEN total_rooms IS NULL THEN area * CASE province_id WHEN 1 THEN 8e7 WHEN 2 THEN 6e7 ELSE 3e7 END * (1 + 0.05::DOUBLE * coalesce(bedroom, 0) + 0.03::DOUBLE * coalesce(bathroom, 0))
  ELSE (i1 + s1 * area_per_room + i2 + s2 * total_rooms) / 2 END AS v FROM t, f WHERE d = DATE '1997-06-30')
SELECT province, origin, voices, count(*) AS n, round(avg(v) / 1000)::BIGINT AS thousands FROM p GROUP BY ALL"""
DAYS_SQL = f"""{MODELS_SQL}, e AS (SELECT d, price, unnest(['area_per_room', 'total_rooms']) AS model, unnest([i1 + s1 * area_per_room, i2 + s2 * total_rooms]) AS p FROM z JOIN f USING (d) WHERE NOT train AND total_rooms IS NOT NULL)
SELECT d::VARCHAR AS day, model, round(1 - sum(pow(price - p, 2)) / (var_pop(price) * count(*)), 5) AS r2, d = DATE '1996-06-30' AS in_service FROM e GROUP BY d, model"""


def searched_models(spark, sf):
    """Straight lines over one feature each, by their errors on folds of days."""
    rows = features.rooms(listings(spark, sf)).where("total_rooms is not null").select("price", "posted_date", "area", *LINES)
    rows = stored(rows)  # every fold and candidate reads them
    starts = folds.origins(rows, "posted_date", 3)
    found = folds.searched(rows, "posted_date", {c: models.line(c) for c in ("area", *LINES)}, "price", starts)
    return folds.standing(found).select("candidate", "folds", F.round(F.col("rmse") / 1000).cast("long").alias("rmse_thousands"), "place")


_FOLDS = FOLDS_SQL[: FOLDS_SQL.index("SELECT fold::INT")]
_FOLDS = _FOLDS.replace("d AS (", "l AS (SELECT *, bedroom + bathroom AS total_rooms, area / nullif(bedroom + bathroom, 0) AS area_per_room FROM listings WHERE bedroom IS NOT NULL AND bathroom IS NOT NULL), d AS (", 1)
_FOLDS = _FOLDS.replace("posted_date FROM listings", "posted_date, price, area, total_rooms, area_per_room FROM l", 1)
_FOLDS = _FOLDS.replace("[1 / 6::DOUBLE, 2 / 6::DOUBLE, 3 / 6::DOUBLE, 4 / 6::DOUBLE, 5 / 6::DOUBLE]", "[1 / 4::DOUBLE, 2 / 4::DOUBLE, 3 / 4::DOUBLE]")
_EACH = ", unnest(['area', 'area_per_room', 'total_rooms']) AS candidate, unnest([area, area_per_room, total_rooms]) AS x"
SEARCHED_SQL = f"""{_FOLDS}, h AS (SELECT fold, day < a AS train, price{_EACH} FROM d JOIN s ON day < b),
m AS (SELECT fold, candidate, regr_slope(price, x) AS k, regr_intercept(price, x) AS i FROM h WHERE train GROUP BY ALL),
e AS (SELECT candidate, fold, sqrt(avg(pow(price - i - k * x, 2))) AS rmse FROM h JOIN m USING (fold, candidate) WHERE NOT train GROUP BY ALL),
g AS (SELECT candidate, count(*) AS folds, avg(rmse) AS rmse FROM e GROUP BY candidate)
SELECT candidate, folds, round(rmse / 1000)::BIGINT AS rmse_thousands, row_number() OVER (ORDER BY rmse, candidate)::INT AS place FROM g"""


def final_validation(spark, sf):
    """How many listings each final range takes; some lie outside of the ranges of price, place and floors."""
    moved = listings(spark, sf).withColumns({"price": F.col("price") / 20, "floor_count": (F.col("floor_count") - 1).cast("int"), "latitude": F.col("latitude") + 1, "province_id": F.col("province_id") * 20})
    return clean.removed(moved)


def _final_sql() -> str:
    shown = {"price": "price / 20", "floor_count": "(floor_count - 1)", "latitude": "(latitude + 1)", "province_id": "(province_id * 20)"}
    ok, out = "TRUE", []
    for i, (c, (low, high)) in enumerate(clean.FINAL.items()):
        x = shown.get(c, c)
        mine = f"coalesce({x} BETWEEN {low} AND {high}, {str(c == 'floor_count').upper()})"
        out.append(f"SELECT {i} AS place, '{c}' AS rule, count(*) FILTER ({ok} AND NOT {mine}) AS removed, count(*) FILTER ({ok} AND {mine}) AS kept FROM listings")
        ok += f" AND {mine}"
    return " UNION ALL ".join(out)


def newest_rows(spark, sf):
    """Listings seen on two data dates, some without one: the newest of each id."""
    r = listings(spark, sf).select("id", "listing_key", "price", F.to_date("posted_date").alias("data_date"))
    again = r.withColumns({"data_date": F.when(F.col("price") % 3 >= 1, F.date_add("data_date", 5)), "price": F.col("price") + 1})
    return dedup.newest(r.unionByName(again)).select("id", "price", F.col("data_date").cast("string").alias("data_date"))


def price_quantiles(spark, sf):
    """Exact quartiles of the price in every district."""
    rows = listings(spark, sf).select("district", "price")
    found = quantiles.exact_by(rows, ["district"], "price", [0.25, 0.5, 0.75])
    return spark.createDataFrame([(*g, *map(float, q)) for g, q in found.items()], "district string, q1 double, median double, q3 double")


PLANS = {
    "served_prices": (served_prices, with_listings(SERVED_SQL)),
    "model_days": (model_days, with_listings(DAYS_SQL)),
    "searched_models": (searched_models, with_listings(SEARCHED_SQL)),
    "final_validation": (final_validation, with_listings(_final_sql())),
    "newest_rows": (
        newest_rows,
        with_listings("u AS (SELECT id, listing_key, price, posted_date::DATE AS data_date FROM listings UNION ALL SELECT id, listing_key, price + 1, CASE WHEN price % 3 >= 1 THEN posted_date::DATE + 5 END FROM listings) SELECT id, price, data_date::VARCHAR AS data_date FROM u QUALIFY row_number() OVER (PARTITION BY id ORDER BY data_date DESC NULLS LAST, listing_key) = 1"),
    ),
    "price_quantiles": (
        price_quantiles,
        with_listings("SELECT district, quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3 FROM listings GROUP BY district"),
    ),
}
