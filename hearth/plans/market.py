"""Market analytics queries and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from hearth.operators import stats
from hearth.sources.adapters import listings, with_listings

AVERAGES = "count(*) AS n, round(avg(price))::BIGINT AS avg_price, round(avg(area), 2) AS avg_area, round(avg(price_per_m2))::BIGINT AS avg_ppm2"
VALUED = "FROM listings WHERE price > 0 AND area > 0"
MISSING = ["price", "area", "bedroom", "bathroom", "floor_count", "latitude"]


def _bins_sql(value: str, bins, extra: str) -> str:
    dim = ", ".join(f"({i}, '{label}', {low}::DOUBLE, {'NULL' if high is None else high}::DOUBLE)" for i, (low, high, label) in enumerate(bins))
    return with_listings(
        f"""SELECT d.bin, d.label, count(l.id) AS n, {extra} FROM (VALUES {dim}) d(bin, label, low, high)
        LEFT JOIN listings l ON l.{value} >= d.low AND (d.high IS NULL OR l.{value} < d.high) GROUP BY d.bin, d.label"""
    )


def _adaptive_sql(value: str, edges, unit: float) -> str:
    rows = ", ".join(
        f"({r}, {cuts[i]}::DOUBLE, {'NULL' if cuts[i + 1] is None else cuts[i + 1]}::DOUBLE)" for r, (_, cuts) in enumerate(edges) for i in range(len(cuts) - 1)
    )
    chosen = " ".join(f"WHEN max(v) / {unit} <= {top} THEN {r}" for r, (top, _) in enumerate(edges) if top)
    return with_listings(
        f"""w AS (SELECT {value} AS v FROM listings WHERE price > 0 AND area > 0),
        m AS (SELECT CASE {chosen} ELSE {len(edges) - 1} END AS regime, count(*) AS total FROM w)
        SELECT b.low, b.high, count(*) AS n, round(sum(v) / count(*))::BIGINT AS avg_value, round(count(*) * 100.0::DOUBLE / any_value(m.total), 1) AS pct
        FROM (VALUES {rows}) b(regime, low, high) JOIN m ON m.regime = b.regime
        JOIN w ON w.v >= b.low * {unit} AND (b.high IS NULL OR w.v < b.high * {unit}) GROUP BY b.low, b.high"""
    )


def dashboard(spark, sf):
    rows = listings(spark, sf)
    recent = F.count_if(F.col("posted_date") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    basic = stats.valued(rows).agg(F.count("*").alias("n"), recent.alias("recent"), stats.whole("price").alias("avg_price")).select(
        F.lit("total").alias("kind"), F.lit("").alias("name"), "n", "recent", "avg_price"
    )
    none = lambda df, kind, key: df.select(F.lit(kind).alias("kind"), F.col(key).alias("name"), "n", F.lit(None).cast("long").alias("recent"), F.lit(None).cast("long").alias("avg_price"))
    return basic.unionByName(none(stats.top_groups(rows, "province", 3), "province", "province")).unionByName(
        none(stats.top_groups(rows, "house_type", 3), "house_type", "house_type")
    )


DASHBOARD_SQL = with_listings(
    f"""a AS (SELECT 'total' AS kind, '' AS name, count(*) AS n, count(*) FILTER (posted_date >= TIMESTAMP '1998-01-01') AS recent, round(avg(price))::BIGINT AS avg_price {VALUED}),
    b AS (SELECT 'province', province, count(*) AS n, NULL, NULL FROM listings WHERE province IS NOT NULL GROUP BY province ORDER BY n DESC, province LIMIT 3),
    c AS (SELECT 'house_type', house_type, count(*) AS n, NULL, NULL FROM listings WHERE house_type IS NOT NULL GROUP BY house_type ORDER BY n DESC, house_type LIMIT 3)
    SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c"""
)


def segments(spark, sf):
    band = F.when(F.col("price") < 1e9, "low").when(F.col("price") < 5e9, "mid").when(F.col("price") < 1e10, "high").otherwise("luxury")
    return listings(spark, sf).groupBy(band.alias("segment")).agg(
        F.count("*").alias("n"), stats.whole("price").alias("avg_price"), F.round(F.avg("area"), 2).alias("avg_area"),
        F.round(F.avg("bedroom"), 4).alias("avg_bedroom"), F.round(F.avg("bathroom"), 4).alias("avg_bathroom"),
    )


def viewset(spark, sf):
    return listings(spark, sf).agg(
        F.count("*").alias("n"), F.count_if(F.col("price") > 5e9).alias("over_5b"), F.count_if(F.col("bedroom") >= 3).alias("rooms_3"),
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), stats.whole("price").alias("avg_price"), F.round(F.avg("area"), 2).alias("avg_area"),
    )


def _profiles(names):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS name, round(avg({c}), 2) AS mean, round(stddev_samp({c}), 2) AS dev, round(min({c})::DOUBLE, 2) AS low, round(max({c})::DOUBLE, 2) AS high, round(quantile_cont({c}, 0.5), 2) AS median FROM listings"
        for c in names
    )


PLANS = {
    "market_overview": (
        lambda s, d: stats.overview(listings(s, d)),
        with_listings(f"SELECT {AVERAGES}, min(price) AS min_price, max(price) AS max_price, count(DISTINCT province) AS provinces, count(DISTINCT district) AS districts {VALUED}"),
    ),
    "market_overview_filtered": (
        lambda s, d: stats.overview(listings(s, d), F.col("province").ilike("%asia%") & F.col("district").ilike("%in%")),
        with_listings(f"SELECT {AVERAGES}, min(price) AS min_price, max(price) AS max_price, count(DISTINCT province) AS provinces, count(DISTINCT district) AS districts {VALUED} AND province ILIKE '%asia%' AND district ILIKE '%in%'"),
    ),
    "price_histogram": (
        lambda s, d: stats.histogram(listings(s, d), "price", stats.PRICE_BINS, [stats.whole("price").alias("avg_price")]),
        _bins_sql("price", stats.PRICE_BINS, "round(avg(l.price))::BIGINT AS avg_price"),
    ),
    "area_histogram": (
        lambda s, d: stats.histogram(listings(s, d), "area", stats.AREA_BINS, [stats.whole("price").alias("avg_price"), stats.whole("price_per_m2").alias("avg_ppm2")]),
        _bins_sql("area", stats.AREA_BINS, "round(avg(l.price))::BIGINT AS avg_price, round(avg(l.price_per_m2))::BIGINT AS avg_ppm2"),
    ),
    "type_stats": (
        lambda s, d: stats.valued(listings(s, d)).where("house_type is not null").groupBy("house_type").agg(*stats.averages(), F.min("price").alias("min_price"), F.max("price").alias("max_price")),
        with_listings(f"SELECT house_type, {AVERAGES}, min(price) AS min_price, max(price) AS max_price {VALUED} AND house_type IS NOT NULL GROUP BY house_type"),
    ),
    "location_stats_province": (
        lambda s, d: stats.by_location(listings(s, d), "province", 10),
        with_listings(f"SELECT province, {AVERAGES} {VALUED} AND province IS NOT NULL GROUP BY province ORDER BY n DESC, province LIMIT 10"),
    ),
    "location_stats_district": (
        lambda s, d: stats.by_location(listings(s, d), "district", 50),
        with_listings(f"SELECT district, province, {AVERAGES} {VALUED} AND district IS NOT NULL GROUP BY district, province ORDER BY n DESC, district, province LIMIT 50"),
    ),
    "price_trend_monthly": (
        lambda s, d: stats.monthly_trend(listings(s, d)),
        with_listings(f"SELECT strftime(date_trunc('month', posted_date), '%Y-%m') AS month, {AVERAGES} {VALUED} GROUP BY 1"),
    ),
    "dashboard_summary": (dashboard, DASHBOARD_SQL),
    "adaptive_price_hist": (
        lambda s, d: stats.adaptive_histogram(stats.valued(listings(s, d)), F.col("price"), stats.PRICE_EDGES, 1e9),
        _adaptive_sql("price", stats.PRICE_EDGES, 1e9),
    ),
    "adaptive_ppm2_hist": (
        lambda s, d: stats.adaptive_histogram(stats.valued(listings(s, d)), F.col("price_per_m2"), stats.PPM2_EDGES, 1e6),
        _adaptive_sql("price_per_m2", stats.PPM2_EDGES, 1e6),
    ),
    "overview_ranges": (
        lambda s, d: stats.adaptive_histogram(stats.valued(listings(s, d)), F.col("price"), stats.OVERVIEW_EDGES, 1e9),
        _adaptive_sql("price", stats.OVERVIEW_EDGES, 1e9),
    ),
    "location_profile": (
        lambda s, d: stats.location_profile(listings(s, d)),
        with_listings(f"SELECT province_id, count(*) AS n, round(avg(price))::BIGINT AS avg_price, min(price) AS min_price, max(price) AS max_price, round(stddev_pop(price))::BIGINT AS std_price, round(avg(area), 2) AS avg_area, round(avg(price) / avg(area))::BIGINT AS ratio_ppm2 {VALUED} GROUP BY province_id"),
    ),
    "district_comparison": (
        lambda s, d: stats.valued(listings(s, d)).where("province = 'ASIA'").groupBy("district").agg(*stats.averages()),
        with_listings(f"SELECT district, {AVERAGES} {VALUED} AND province = 'ASIA' GROUP BY district"),
    ),
    "district_analytics": (
        lambda s, d: stats.valued(listings(s, d)).groupBy("province_id", "district_id").agg(*stats.averages()),
        with_listings(f"SELECT province_id, district_id, {AVERAGES} {VALUED} GROUP BY province_id, district_id"),
    ),
    "viewset_stats": (
        viewset,
        with_listings("SELECT count(*) AS n, count(*) FILTER (price > 5e9) AS over_5b, count(*) FILTER (bedroom >= 3) AS rooms_3, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, round(avg(price))::BIGINT AS avg_price, round(avg(area), 2) AS avg_area FROM listings"),
    ),
    "group_counts": (
        lambda s, d: stats.share_of_total(listings(s, d).groupBy("source", "province").agg(F.count("*").alias("n"))),
        with_listings("g AS (SELECT source, province, count(*) AS n FROM listings GROUP BY ALL) SELECT *, round(n * 100.0::DOUBLE / sum(n) OVER (), 1) AS pct FROM g"),
    ),
    "top_provinces": (
        lambda s, d: stats.top_groups(listings(s, d), "province", 10),
        with_listings("SELECT province, count(*) AS n FROM listings WHERE province IS NOT NULL GROUP BY province ORDER BY n DESC, province LIMIT 10"),
    ),
    "missing_profile": (
        lambda s, d: stats.missing_profile(listings(s, d), MISSING),
        with_listings("SELECT count(*) AS rows, " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS missing_{c}" for c in MISSING) + " FROM listings"),
    ),
    "numeric_profile": (lambda s, d: stats.numeric_profile(listings(s, d), ["area", "bedroom", "floor_count"]), with_listings(_profiles(["area", "bedroom", "floor_count"]))),
    "segment_stats": (
        segments,
        with_listings("SELECT CASE WHEN price < 1e9 THEN 'low' WHEN price < 5e9 THEN 'mid' WHEN price < 1e10 THEN 'high' ELSE 'luxury' END AS segment, count(*) AS n, round(avg(price))::BIGINT AS avg_price, round(avg(area), 2) AS avg_area, round(avg(bedroom), 4) AS avg_bedroom, round(avg(bathroom), 4) AS avg_bathroom FROM listings GROUP BY 1"),
    ),
    "table_counts": (
        lambda s, d: listings(s, d).agg(F.lit("listings").alias("name"), F.count("*").alias("n")).unionAll(listings(s, d).agg(F.lit("districts").alias("name"), F.count_distinct("district").alias("n"))),
        with_listings("SELECT 'listings' AS name, count(*) AS n FROM listings UNION ALL SELECT 'districts', count(DISTINCT district) FROM listings"),
    ),
}
