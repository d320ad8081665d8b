"""Search, paging, radius, suggestion and similarity queries over listings; each a single lazy plan."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions import geo

SORTABLE = ("price", "area", "price_per_m2", "bedroom", "posted_date", "processing_timestamp")
MAX_PAGE = 100


def like(text: str) -> str:
    """A substring pattern; wildcards in the text are literal."""
    return "%" + text.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_") + "%"


# The columns a text search reads, as far as the rows have them.
TEXTS = ("title", "description", "location", "province", "district", "ward", "street")


@dataclass(frozen=True)
class SearchFilter:
    """Search parameters; absent ones do not restrict.  ``equal`` holds exact values (source, ids, codes) by column."""

    province: str | None = None
    district: str | None = None
    ward: str | None = None
    street: str | None = None
    house_type: str | None = None
    keyword: str | None = None
    price: tuple[float | None, float | None] = (None, None)
    area: tuple[float | None, float | None] = (None, None)
    bedroom: int | tuple[int | None, int | None] | None = None
    bathroom: int | tuple[int | None, int | None] | None = None
    posted_since: str | None = None
    text: str | None = None
    equal: tuple[tuple[str, object], ...] = ()

    def predicate(self, columns: list[str] | None = None) -> Column:
        """``columns`` are those of the rows; ``text`` needs them."""
        parts = [F.lit(True)]
        for name in ("province", "district", "ward", "street", "house_type"):
            if value := getattr(self, name):
                parts.append(F.col(name).ilike(like(value)))
        for name in ("price", "area", "bedroom", "bathroom"):
            value = getattr(self, name)
            if isinstance(value, tuple):
                low, high = value
                parts += [F.col(name) >= low] if low is not None else []
                parts += [F.col(name) <= high] if high is not None else []
            elif value is not None:
                parts.append(F.col(name) == value)
        if self.keyword:
            k = like(self.keyword)
            parts.append(F.col("title").ilike(k) | F.col("street").ilike(k) | F.col("house_type").ilike(k))
        if self.text:
            parts.append(reduce(Column.__or__, [F.col(c).ilike(like(self.text)) for c in TEXTS if c in (columns or TEXTS)]))
        if self.posted_since:
            parts.append(F.col("posted_date") >= F.lit(self.posted_since).cast("timestamp_ntz"))
        parts += [F.col(c) == F.lit(v) for c, v in self.equal]
        return reduce(Column.__and__, parts)


def listed(listings: DataFrame) -> DataFrame:
    """Listings with a source and a title that is not empty: what the serving views show."""
    return listings.where(F.col("title").isNotNull() & F.col("source").isNotNull() & (F.col("title") != ""))


def search(listings: DataFrame, wanted: SearchFilter, sort_by: str = "posted_date", descending: bool = True, page: int = 1, size: int = 20) -> DataFrame:
    """One page; the sort column must be on the list, ties go by the listing's key."""
    if sort_by not in SORTABLE:
        raise ValueError(f"cannot sort by {sort_by!r}")
    size = min(size, MAX_PAGE)
    order = F.col(sort_by).desc_nulls_last() if descending else F.col(sort_by).asc_nulls_last()
    return listings.where(wanted.predicate(listings.columns)).orderBy(order, "listing_key").offset((page - 1) * size).limit(size)


def page_info(listings: DataFrame, wanted: SearchFilter, page: int, size: int) -> DataFrame:
    total = listings.where(wanted.predicate(listings.columns)).agg(F.count("*").alias("total"))
    pages = F.ceil(F.col("total") / size).cast("long")
    return total.select("total", pages.alias("total_pages"), (F.lit(page) < pages).alias("has_next"), F.lit(page > 1).alias("has_previous"))


def within_radius(listings: DataFrame, lat: float, lon: float, radius_m: float = 5000, limit: int = 50) -> DataFrame:
    """Nearest listings inside the radius; a bounding box prunes before the trigonometry."""
    near = listings.where(geo.bounding_box(F.col("latitude"), F.col("longitude"), lat, lon, radius_m))
    found = near.withColumn("distance", geo.cosine_distance(F.col("latitude"), F.col("longitude"), lat, lon)).where(F.col("distance") <= radius_m)
    return found.orderBy("distance", "listing_key").limit(limit)


def suggestions(listings: DataFrame, text: str, per_kind: int = 5, limit: int = 10) -> DataFrame:
    """Province, district and street names that contain the text, the most frequent of each kind first."""
    if len(text) < 2:
        return listings.select(F.lit(0).alias("place"), F.lit("").alias("kind"), F.col("province").alias("name"), F.lit(0).cast("long").alias("n")).limit(0)
    parts = None
    for place, kind in enumerate(("province", "district", "street")):
        top = (
            listings.where(F.col(kind).ilike(like(text))).groupBy(F.col(kind).alias("name")).agg(F.count("*").alias("n"))
            .orderBy(F.desc("n"), "name").limit(per_kind).select(F.lit(place).alias("place"), F.lit(kind).alias("kind"), "name", "n")
        )
        parts = top if parts is None else parts.unionAll(top)
    return parts.orderBy("place", F.desc("n"), "name").limit(limit)


def similar(listings: DataFrame, anchor: DataFrame, limit: int = 5, tolerance: float = 0.2) -> DataFrame:
    """Listings of the anchor's district within the price band, nearest in price first; ``anchor`` is one row of the listings.

    Its values are literals of the plan, so other districts and prices are left out before the listings are put together.
    """
    a = anchor.select("district", "price", "listing_key").first()
    if a is None:
        return listings.limit(0).withColumn("gap", F.lit(0.0))
    price = F.lit(a.price).cast("double")
    near = (F.col("district") == F.lit(a.district)) & F.col("price").between(price * (1 - tolerance), price * (1 + tolerance))
    found = listings.where(near & (F.col("listing_key") != F.lit(a.listing_key)))
    return found.withColumn("gap", F.abs(F.col("price") - price)).orderBy("gap", "listing_key").limit(limit)


def recommended(listings: DataFrame, anchor: DataFrame, limit: int = 5) -> DataFrame:
    """The newest shown listings of the anchor's district but the anchor; ``anchor`` is one row of the listings, its values literals of the plan."""
    a = anchor.select("district_id", "listing_key").first()
    if a is None:
        return listings.limit(0)
    found = listed(listings).where((F.col("district_id") == F.lit(a.district_id)) & (F.col("listing_key") != F.lit(a.listing_key)))
    return found.orderBy(F.col("posted_date").desc(), "listing_key").limit(limit)


def banded(listings: DataFrame, price: float, area: float, bedroom: int, limit: int = 12) -> DataFrame:
    """Price within 30 %, area within 40 %, bedrooms within 2; nearest in price."""
    near = (
        F.col("price").between(price * 0.7, price * 1.3) & F.col("area").between(area * 0.6, area * 1.4) & F.col("bedroom").between(bedroom - 2, bedroom + 2)
    )
    return listings.where(near).orderBy(F.abs(F.col("price") - price), "listing_key").limit(limit)


def newest(listings: DataFrame, where: Column, limit: int) -> DataFrame:
    return listings.where(where).orderBy(F.col("posted_date").desc(), "listing_key").limit(limit)


def options(listings: DataFrame, parent: str, value: str, child: str) -> DataFrame:
    """Choices of the next level of the address hierarchy."""
    return listings.where(F.col(parent) == value).select(child).distinct()


def recent_partitions(rows: DataFrame, day: str, n: int) -> DataFrame:
    """Rows of the ``n`` latest days: the days are few, only they are ordered."""
    latest = rows.select(day).distinct().orderBy(F.desc(day)).limit(n)
    return rows.join(F.broadcast(latest), day, "left_semi")
