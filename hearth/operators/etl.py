"""The daily pipeline: raw sources to silver, one gold table, and the load into the serving table.

Every stage is a lazy ``DataFrame -> DataFrame`` step; run date, run id and "now" are parameters, so a run can be repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearth.functions import parse, quality
from hearth.operators import conform, dedup, merge
from hearth.sources import buckets, paths

# The gold schema and the serving columns.
GOLD = (
    "id string, url string, source string, title string, description string, location string, data_type string, province string, district string, ward string, street string, "
    "province_id int, district_id int, ward_id int, street_id int, latitude double, longitude double, price double, area double, price_per_m2 double, bedroom double, bathroom double, "
    "floor_count double, house_direction string, house_direction_code int, legal_status string, legal_status_code int, interior string, interior_code int, house_type string, "
    "house_type_code int, width double, length double, living_size double, facade_width double, road_width double, posted_date timestamp, crawl_timestamp timestamp, "
    "processing_timestamp timestamp, processing_id string, data_quality_score double"
)


def _text(name: str) -> Column:
    return F.nullif(F.trim(F.col(name)), F.lit(""))


def _common(raw: DataFrame, source: str, now: Column, run_id: str) -> dict[str, Column]:
    out = {c: _text(c) for c in ("url", "title", "description", "location", "data_type")}
    out["source"] = F.coalesce(_text("source"), F.lit(source))
    out |= {"latitude": parse.latitude(F.col("latitude").try_cast("double")), "longitude": parse.longitude(F.col("longitude").try_cast("double"))}
    out |= {c: parse.timestamp(_text(c)) for c in ("posted_date", "crawl_timestamp")}
    return out | {"processing_timestamp": now, "processing_id": F.lit(run_id)}


def valid(silver: DataFrame) -> DataFrame:
    """An area, a price or a price by area, and a location of some length."""
    return silver.where((F.col("area") > 0) & ((F.col("price") > 0) | F.col("price_per_m2").isNotNull()) & (F.length("location") > 5))


def silver_a(raw: DataFrame, now: Column, run_id: str, source: str = "src_a") -> DataFrame:
    """The free-text source: unit-aware prices, swapped fields, classes by key words."""
    price_text, per_text = parse.unswapped(_text("price"), _text("price_per_m2"))
    area = parse.local_number(_text("area"))
    price = parse.unit_price(price_text)
    columns = _common(raw, source, now, run_id) | {
        "area": area, "price": price, "price_per_m2": parse.per_m2_or_derived(per_text, price, area),
        "bedroom": parse.digits(_text("bedroom")), "bathroom": parse.digits(_text("bathroom")), "floor_count": parse.digits(_text("floor_count")),
        "facade_width": parse.local_number(_text("facade_width")), "road_width": parse.local_number(_text("road_width")),
    }
    for name, classify in (("house_direction", parse.direction), ("legal_status", parse.legal_status), ("interior", parse.interior)):
        columns[name], columns[f"{name}_code"] = classify(_text(name))
    kept = raw.where(~parse.invalid_unit(_text("price")) & ~parse.negotiable(_text("price")))
    return valid(kept.select(*[c.alias(n) for n, c in columns.items()]))


def silver_b(raw: DataFrame, now: Column, run_id: str, source: str = "src_b") -> DataFrame:
    """The coded source: plain numbers, price by area in millions, classes by code."""
    price, area = parse.plain_number(_text("price")), parse.plain_number(_text("area"))
    columns = _common(raw, source, now, run_id) | {
        "area": area, "price": price, "price_per_m2": F.coalesce(parse.plain_number(_text("price_per_m2")) * 1e6, F.round(F.try_divide(price, F.nullif(area, F.lit(0.0))), 2)),
        **{c: parse.plain_number(_text(c)) for c in ("bedroom", "bathroom", "floor_count", "width", "length", "living_size")},
    }
    names = {"house_direction": parse.DIRECTIONS, "legal_status": parse.LEGAL, "interior": parse.INTERIOR, "house_type": parse.HOUSE_TYPES}
    for name, table in names.items():
        columns[name], columns[f"{name}_code"] = parse.decode(_text(name), table)
    kept = raw.where(~parse.invalid_unit(_text("price")))
    return valid(kept.select(*[c.alias(n) for n, c in columns.items()]))


def addressed(silver: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Names and ids of the four address levels: successive left joins on the keys found so far; unresolved ids are -1.

    Dimensions with two rows of one key keep the one of the least id, so a join never multiplies listings.
    """
    parts = parse.address_parts(F.col("location"))
    rows = silver.withColumns({f"_{level}": parse.address_key(text, level) for level, text in parts.items()})
    rows = rows.withColumns({level: text for level, text in parts.items()})
    found: list[str] = []
    for level, kind in (("province", "provinces"), ("district", "districts"), ("ward", "wards"), ("street", "streets")):
        on = found[:2]  # wards and streets both hang on the district
        dim = dims[kind].withColumn("_key", parse.address_key(F.col("name"), level)).groupBy(*on, "_key").agg(F.min_by("name", f"{level}_id").alias("_name"), F.min(f"{level}_id").alias(f"{level}_id"))
        d = dim.select(*[F.col(c).alias(f"_d_{c}") for c in on], F.col("_key").alias("_d_key"), "_name", f"{level}_id")
        condition = F.col(f"_{level}") == F.col("_d_key")
        for c in on:
            condition = condition & (F.col(c) == F.col(f"_d_{c}"))
        rows = rows.join(d, condition, "left").withColumn(level, F.coalesce("_name", level)).drop("_name", "_d_key", *[f"_d_{c}" for c in on])
        found.append(f"{level}_id")
    return rows.withColumns({c: F.coalesce(F.col(c).cast("int"), F.lit(-1)) for c in found}).drop(*[f"_{level}" for level in parts])


def _present() -> dict[str, Column]:
    return quality.flags(*[F.col(c) for c in ("price", "area", "bedroom", "bathroom", "location", "latitude", "longitude")])


def gold(silvers: list[DataFrame]) -> DataFrame:
    """One schema, ids, scores, then duplicates by id, by fingerprint and by likeness; unresolved provinces go."""
    schema = StructType.fromDDL(GOLD)
    union = None
    for s in silvers:
        part = conform.conform(s, schema)
        union = part if union is None else union.unionByName(part)
    present = _present()
    rows = union.withColumns(
        {
            "id": conform.surrogate_id(F.col("url"), F.col("source"), F.concat_ws("|", "title", "location", F.col("price").cast("string"))),
            "data_quality_score": quality.score(present).cast("double"),
        }
    ).withColumns(
        {
            "property_type": parse.derived_type(F.col("data_type"), F.col("bedroom"), F.col("area")),
            "quality_level": quality.level(F.col("data_quality_score")),
            "data_quality_issues": quality.issue(present),
            "listing_key": F.col("id"),
            "score": F.col("data_quality_score"),
        }
    )
    order = [F.desc("score"), F.desc("processing_timestamp"), F.asc("source"), F.asc("listing_key"), F.asc("title")]
    one = dedup.best_of(rows, ["id"], *order)
    exact = dedup.best_of(one.withColumn("_fingerprint", dedup.exact_key()), ["_fingerprint"], *order).drop("_fingerprint")
    return dedup.without_fuzzy(exact).where(F.col("province_id") != -1).drop("listing_key", "score")


def load(serving: DataFrame, new: DataFrame, as_of: Column, days: int = 90) -> DataFrame:
    """The serving table after the load: conflicts against the last days are resolved, the rest is upserted by rule."""
    scored = lambda df: df.withColumn("score", F.col("data_quality_score"))
    staged, target = scored(new), scored(serving)
    recent = target.where(F.col("processing_timestamp") >= as_of - F.make_interval(days=F.lit(days)))
    accepted = dedup.resolved(staged, dedup.conflicts(staged, recent))
    return merge.upsert(target, accepted.select(*target.columns)).drop("score")


def load_buckets(spark: SparkSession, path: str, new: DataFrame, as_of: Column, days: int = 90) -> dict[str, int]:
    """The same load into a table of key buckets, which rewrites only those of the accepted keys; the first load makes the table."""
    staged = new.withColumn("score", F.col("data_quality_score"))
    if not paths.exists(spark, path):
        buckets.create(staged, path, ["id"])
        return {}
    target = buckets.read(spark, path)
    recent = target.where(F.col("processing_timestamp") >= as_of - F.make_interval(days=F.lit(days)))
    accepted = dedup.resolved(staged, dedup.conflicts(staged, recent))
    return buckets.merge_into(spark, path, accepted.select(*target.columns), ["id"], buckets.by_score)
