"""Search and retrieval queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.functions import parse
from hearth.operators import search as ops
from hearth.operators.search import SearchFilter
from hearth.sources.adapters import leading_listings, listing_key, listings, table, with_listings

SHOWN = ["listing_key", "title", "price", "area", "province", "district"]
SHOWN_SQL = ", ".join(SHOWN)
WANTED = SearchFilter(province="asia", price=(2e9, 8e9), area=(50, None), bedroom=2)
WANTED_SQL = "province ILIKE '%asia%' AND price >= 2e9 AND price <= 8e9 AND area >= 50 AND bedroom = 2"
HERE = (9.0, 102.05, 50000.0)
DISTANCE = f"6371000.0 * acos(greatest(-1.0, least(1.0, cos(radians({HERE[0]})) * cos(radians(latitude)) * cos(radians(longitude) - radians({HERE[1]})) + sin(radians({HERE[0]})) * sin(radians(latitude)))))"
ANCHOR = "(SELECT listing_key FROM listings ORDER BY listing_key LIMIT 1)"


def anchor(spark, sf):
    return leading_listings(spark, sf).orderBy("listing_key").limit(1)


def _suggest_sql(text: str) -> str:
    part = lambda i, k: f"(SELECT {i} AS place, '{k}' AS kind, {k} AS name, count(*) AS n FROM listings WHERE {k} ILIKE '%{text}%' GROUP BY {k} ORDER BY n DESC, name LIMIT 5)"
    return with_listings("SELECT place, kind, name, n FROM (" + " UNION ALL ".join(part(i, k) for i, k in enumerate(("province", "district", "street"))) + ") ORDER BY place, n DESC, name LIMIT 10")


def similar(spark, sf):
    return ops.similar(listings(spark, sf), anchor(spark, sf)).select(*SHOWN, "gap")


def compare(spark, sf):
    """The asked keys pick the lines, of which the listings are made."""
    asked = leading_listings(spark, sf, 4).select("listing_key").distinct().orderBy("listing_key").limit(4)
    lines = table(spark, sf, "lineitem").where(listing_key().isin([r.listing_key for r in asked.collect()]))
    return listings(spark, sf, lines).select(*SHOWN, "bedroom", F.round("price_per_m2", 2).alias("ppm2"))


def texts(rows):
    return rows.withColumns({"location": F.concat_ws(", ", "district", "province"), "description": F.col("house_type")})


def shown_price(price):
    """Billions with one decimal, millions without, else the whole amount; half to even."""
    short = lambda unit, digits: F.bround((price / unit).cast("decimal(20,6)"), digits)
    return (
        F.when(price >= 1e9, F.concat(short(1e9, 1).cast("decimal(20,1)").cast("string"), F.lit(" tỷ")))
        .when(price >= 1e6, F.concat(short(1e6, 0).cast("long").cast("string"), F.lit(" triệu")))
        .when(price > 0, F.concat(F.format_number(F.floor(price), 0), F.lit(" VND")))
    )


SHOWN_PRICE_SQL = "CASE WHEN price >= 1e9 THEN round_even((price / 1e9)::DECIMAL(20,6), 1)::DECIMAL(20,1)::VARCHAR || ' tỷ' WHEN price >= 1e6 THEN round_even((price / 1e6)::DECIMAL(20,6), 0)::BIGINT || ' triệu' WHEN price > 0 THEN format('{:,}', floor(price)::BIGINT) || ' VND' END"
NARROW = SearchFilter(text="nation_1", equal=(("source", "src_b"), ("province_id", 1)), bedroom=(2, 4), bathroom=(1, None), area=(None, 400))
NARROW_SQL = "source = 'src_b' AND province_id = 1 AND bedroom BETWEEN 2 AND 4 AND bathroom >= 1 AND area <= 400 AND (" + " OR ".join(f"contains(lower({c}), 'nation_1')" for c in ("title", "house_type", "district || ', ' || province", "province", "district", "ward", "street")) + ")"


PLANS = {
    "advanced_search": (
        lambda s, d: ops.search(listings(s, d), WANTED, "price", True, 2, 20).select(*SHOWN),
        with_listings(f"SELECT {SHOWN_SQL} FROM listings WHERE {WANTED_SQL} ORDER BY price DESC NULLS LAST, listing_key LIMIT 20 OFFSET 20"),
    ),
    "search_keyword": (
        lambda s, d: ops.search(listings(s, d), SearchFilter(keyword="an", posted_since="1996-06-01"), "posted_date", True, 1, 50).select(*SHOWN),
        with_listings(f"SELECT {SHOWN_SQL} FROM listings WHERE (title ILIKE '%an%' OR street ILIKE '%an%' OR house_type ILIKE '%an%') AND posted_date >= TIMESTAMP '1996-06-01' ORDER BY posted_date DESC NULLS LAST, listing_key LIMIT 50"),
    ),
    "search_page_info": (
        lambda s, d: ops.page_info(listings(s, d), WANTED, 2, 20),
        with_listings(f"SELECT count(*) AS total, ceil(count(*) / 20.0)::BIGINT AS total_pages, 2 < ceil(count(*) / 20.0) AS has_next, true AS has_previous FROM listings WHERE {WANTED_SQL}"),
    ),
    "location_search": (
        lambda s, d: ops.newest(listings(s, d), F.col("province").ilike("%europe%") & F.col("district").ilike("%n_1%"), 50).select(*SHOWN),
        with_listings(f"SELECT {SHOWN_SQL} FROM listings WHERE province ILIKE '%europe%' AND district ILIKE '%n_1%' ORDER BY posted_date DESC, listing_key LIMIT 50"),
    ),
    "radius_search": (
        lambda s, d: ops.within_radius(listings(s, d), *HERE).select(*SHOWN, F.round("distance", 1).alias("distance")),
        with_listings(f"SELECT {SHOWN_SQL}, round({DISTANCE}, 1) AS distance FROM listings WHERE {DISTANCE} <= {HERE[2]} ORDER BY {DISTANCE}, listing_key LIMIT 50"),
    ),
    "suggestions": (lambda s, d: ops.suggestions(listings(s, d), "an").select("place", "kind", "name", "n"), _suggest_sql("an")),
    "similar": (
        similar,
        with_listings(f"a AS (SELECT * FROM listings WHERE listing_key = {ANCHOR} LIMIT 1) SELECT {', '.join('l.' + c for c in SHOWN)}, abs(l.price - a.price) AS gap FROM listings l JOIN a ON l.district = a.district AND l.price BETWEEN a.price * (1 - 0.2::DOUBLE) AND a.price * (1 + 0.2::DOUBLE) AND l.listing_key <> a.listing_key ORDER BY gap, l.listing_key LIMIT 5"),
    ),
    "recommend": (
        lambda s, d: ops.recommended(listings(s, d), anchor(s, d)).select(*SHOWN),
        with_listings(f"SELECT {SHOWN_SQL} FROM listings WHERE district_id = (SELECT district_id FROM listings WHERE listing_key = {ANCHOR} LIMIT 1) AND listing_key <> {ANCHOR} AND title <> '' AND source IS NOT NULL ORDER BY posted_date DESC, listing_key LIMIT 5"),
    ),
    "filtered_listings": (
        lambda s, d: (lambda rows: rows.where(NARROW.predicate(rows.columns)))(ops.listed(texts(listings(s, d)))).select(*SHOWN),
        with_listings(f"SELECT {SHOWN_SQL} FROM listings WHERE title <> '' AND source IS NOT NULL AND {NARROW_SQL}"),
    ),
    "price_band": (
        lambda s, d: ops.banded(listings(s, d), 5e9, 200, 3).select(*SHOWN),
        with_listings(f"SELECT {SHOWN_SQL} FROM listings WHERE price BETWEEN 5e9 * 0.7 AND 5e9 * 1.3 AND area BETWEEN 120 AND 280 AND bedroom BETWEEN 1 AND 5 ORDER BY abs(price - 5e9), listing_key LIMIT 12"),
    ),
    "id_in_compare": (
        compare,
        with_listings(f"SELECT {SHOWN_SQL}, bedroom, round(price_per_m2, 2) AS ppm2 FROM listings WHERE listing_key IN (SELECT DISTINCT listing_key FROM listings ORDER BY 1 LIMIT 4)"),
    ),
    "address_options": (
        lambda s, d: ops.options(listings(s, d), "province", "EUROPE", "district"),
        with_listings("SELECT DISTINCT district FROM listings WHERE province = 'EUROPE'"),
    ),
    "recent_partitions": (
        lambda s, d: ops.recent_partitions(listings(s, d).withColumn("day", F.to_date("processing_timestamp")), "day", 3).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n")),
        with_listings("p AS (SELECT processing_timestamp::DATE AS day, dense_rank() OVER (ORDER BY processing_timestamp::DATE DESC) AS k FROM listings) SELECT day::VARCHAR AS day, count(*) AS n FROM p WHERE k <= 3 GROUP BY day"),
    ),
    "full_address": (
        lambda s, d: listings(s, d).select("listing_key", parse.joined(F.col("street"), F.col("ward"), F.col("district"), F.col("province")).alias("full_address")),
        with_listings("SELECT listing_key, concat_ws(', ', nullif(trim(street), ''), nullif(trim(ward), ''), nullif(trim(district), ''), nullif(trim(province), '')) AS full_address FROM listings"),
    ),
    "formatted_price": (
        lambda s, d: listings(s, d).withColumn("price", F.col("price") / F.lit(10.0) ** (F.col("district_id") % 6)).select("listing_key", shown_price(F.col("price")).alias("shown")),
        with_listings(f"f AS (SELECT listing_key, price / pow(10.0::DOUBLE, district_id % 6) AS price FROM listings) SELECT listing_key, {SHOWN_PRICE_SQL} AS shown FROM f"),
    ),
}
